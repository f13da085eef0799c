import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lumenframe.llm import infill as I

TEXTS = st.text(alphabet=st.sampled_from("a\n\r\x0b\x8aé日😀\0Ċ<"), max_size=60)


@given(TEXTS)
def test_units_and_counts_equal_a_regex(text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    units = I.Units(text.encode())
    assert units.n == len(lines)
    for k in range(len(lines) + 1):
        assert text.encode()[: units.after(k)].decode() == "".join(lines[:k])
    assert I.char_count(text.encode()) == len(text)


def plain(key, text, rate=100, first=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    said = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h = [int(said[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return {"n": len(lines), "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    form, output = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < first else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return {"n": len(lines), "form": form, "prefix_chars": len(p), "middle_chars": len(m), "output": output}


@given(st.integers(0, 10_000), TEXTS, st.integers(0, 100), st.integers(0, 100))
def test_one_text_equals_brute_force(key, text, rate, first):
    settings = I.Settings(rate=rate, suffix_first=first)
    assert I.infilled(str(key), text.encode(), settings) == plain(key, text, rate, first)


def test_long_text():
    text = "".join(f"line {k} é\n" for k in range(100_000)) + "end"
    assert I.infilled("5", text.encode(), I.Settings()) == plain(5, text)


def test_settings():
    for marks in (("<P>", "<P>", "<M>"), ("aba", "b", "c"), ("", "b", "c"), ("xy", "yz", "c")):
        with pytest.raises(ValueError):
            I.Settings(sentinels=marks)
    with pytest.raises(ValueError):
        I.Settings(end=0)


def test_table_with_odd_rows(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(k, t) for k, t in enumerate(["<P", "P>\n<S\n", "a<M>b", "<S>", "\n\n", "<\n<P\n>"] * 4)], "doc_id long, text string")
    docs = odd_docs.withColumn("infill", odd_docs["score"]).unionByName(more, allowMissingColumns=True)
    found, name = I.fill_in_middle(docs)
    assert found.columns[:-1] == docs.columns and name == "_infill"
    kept = found.withColumn("back", I.restored(found[name]["output"], found[name]["form"]))
    forms = set()
    for r in kept.collect():
        key = "" if r["doc_id"] is None else r["doc_id"]
        assert r[name].asDict() == plain(key, r["text"] or "")
        assert r["back"] == (r["text"] or "")
        forms.add(r[name]["form"])
    assert forms == {"plain", "psm", "spm"}
    assert I.fill_in_middle(no_docs)[0].count() == 0
