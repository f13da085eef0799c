import random
import re

from lumenframe.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item, said in items:
        w = words(said)
        size = min(13, len(w))
        windows = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
        for at in range(len(doc) - size + 1):
            if tuple(doc[at : at + size]) in windows:
                hit.update(range(at, at + size))
                found.add(item)
    return len(doc), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(doc)


def measure(docs, items, **kwargs):
    from pyspark.sql import functions as F

    matched, name = D.find_matches(docs, items, **kwargs)
    ids = F.array_sort(F.array_distinct(F.transform(F.col(name)["matches"], lambda m: m["item_id"])))
    columns = {k: v for k, v in D.measured(matched, name).items() if k != "items_sha256"}
    return matched.select("text", ids.alias("ids"), *[c.alias(n) for n, c in columns.items()]).collect()


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "é", "日本", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(k), text(rng.choice([2, 5, 13, 14, 30]))) for k in range(8)] + [("n", None), ("p", "?!")]
    texts = [text(rng.choice([0, 1, 12, 40, 300])) for _ in range(40)] + [None, ""]
    texts += ["zz " * 200 + items[1][1].upper() + " zz" * 50, items[0][1] + ", " + items[0][1]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    tests = spark.createDataFrame(items, "item_id string, text string")
    for blocks in (1 << 20, 40):  # one matcher, then several
        for r in measure(docs, tests, block_chars=blocks):
            n, hit, ids, bad = brute(r["text"], items)
            assert (r["n_words"], r["n_hit"], r["ids"], r["contaminated"]) == (n, hit, ids, bad), r["text"]


def test_longest_match_has_its_place(spark):
    item = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([("x y " + item[:60] + " " + item,)], "text string")
    matched, name = D.find_matches(docs, spark.createDataFrame([("i", item)], "item_id string, text string"))
    longest = max(matched.first()[name]["matches"], key=lambda m: m["n_words"])
    assert (longest["item_start"], longest["n_words"]) == (0, 20)


def test_odd_rows(spark, odd_docs, no_docs):
    items = odd_docs.selectExpr("doc_id as item_id", "text")
    matched, name = D.find_matches(odd_docs, items)
    assert matched.count() == odd_docs.count()
    kept = D.remove_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == ["", "", "  \n\t ", "No id, 日本語 words 😀😀 here"]
    assert D.remove_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert D.remove_contaminated(no_docs, items).count() == 0
