"""English suffix stripping after M. F. Porter, "An algorithm for suffix stripping" (1980),
with the commonly used later amendments (irregular words, short -ies/-ied words, -bli, -fulli, -logi).

Texts arrive in Arrow batches; each distinct word of a batch is stemmed once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words with a set stem.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
# Suffix rules of the paper. The first suffix that fits decides.
STEP_2 = (
    "ational ate", "tional tion", "enci ence", "anci ance", "izer ize", "bli ble", "alli al", "entli ent",
    "eli e", "ousli ous", "ization ize", "ation ate", "ator ate", "alism al", "iveness ive", "fulness ful",
    "ousness ous", "aliti al", "iviti ive", "biliti ble", "fulli ful",
)
STEP_3 = ("icate ic", "ative ", "alize al", "iciti ic", "ical ic", "ful ", "ness ")
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def make_stemmer():
    """The stemming function, built without module state so that it travels inside a UDF."""
    import re

    irregular = dict(IRREGULAR)
    rules = {n: [tuple(r.split(" ")) for r in step] for n, step in ((2, STEP_2), (3, STEP_3))}
    endings = tuple(STEP_4)
    syllable = re.compile("v+c+")

    def shape(word: str) -> str:
        """Consonants and vowels; y is a vowel after a consonant."""
        out: list[str] = []
        for ch in word:
            vowel = ch in "aeiou" or (ch == "y" and bool(out) and out[-1] == "c")
            out.append("v" if vowel else "c")
        return "".join(out)

    def measure(stem: str) -> int:
        return len(syllable.findall(shape(stem)))

    def short_end(stem: str) -> bool:
        form = shape(stem)
        return (form.endswith("cvc") and stem[-1] not in "wxy") or form == "vc"

    def plural(w: str) -> str:
        if w.endswith("sses"):
            return w[:-2]
        if w.endswith("ies"):
            return w[:-1] if len(w) == 4 else w[:-2]
        return w[:-1] if w.endswith("s") and not w.endswith("ss") else w

    def past(w: str) -> str:
        if w.endswith("ied"):
            return w[:-1] if len(w) == 4 else w[:-2]
        if w.endswith("eed"):
            return w[:-1] if measure(w[:-3]) > 0 else w
        for ending in ("ed", "ing"):
            stem = w[: -len(ending)]
            if w.endswith(ending) and "v" in shape(stem):
                if stem.endswith(("at", "bl", "iz")):
                    return stem + "e"
                if len(stem) > 1 and stem[-1] == stem[-2] and shape(stem)[-1] == "c":
                    return stem if stem[-1] in "lsz" else stem[:-1]
                return stem + "e" if measure(stem) == 1 and short_end(stem) else stem
        return w

    def final_y(w: str) -> str:
        stem = w[:-1]
        return stem + "i" if w.endswith("y") and len(stem) > 1 and shape(stem)[-1] == "c" else w

    def suffix(w: str, step: int) -> str:
        for old, new in rules[step]:
            if w.endswith(old):
                stem = w[: -len(old)]
                if measure(stem) == 0:
                    return w
                return suffix(stem + new, step) if old == "alli" else stem + new
        if step == 2 and w.endswith("logi") and measure(w[:-3]) > 0:
            return w[:-1]
        return w

    def ending(w: str) -> str:
        for old in endings:
            if w.endswith(old):
                stem = w[: -len(old)]
                fits = measure(stem) > 1 and (old != "ion" or stem.endswith(("s", "t")))
                return stem if fits else w
        return w

    def tidy(w: str) -> str:
        if w.endswith("e"):
            stem = w[:-1]
            m = measure(stem)
            if m > 1 or (m == 1 and not short_end(stem)):
                w = stem
        return w[:-1] if w.endswith("ll") and measure(w[:-1]) > 1 else w

    def stem(word: str) -> str:
        if word in irregular:
            return irregular[word]
        if len(word) <= 2:
            return word
        w = final_y(past(plural(word)))
        return tidy(ending(suffix(suffix(w, 2), 3)))

    return stem


def stemmed(tokens: Column) -> Column:
    """Array of words to array of stems."""
    stem = make_stemmer()

    def per_batch(words: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def one(row):
            if row is None:
                return None
            for w in row:
                if w not in known:
                    known[w] = stem(w)
            return [known[w] for w in row]

        return words.map(one)

    return F.pandas_udf(per_batch, T.ArrayType(T.StringType()))(tokens)
