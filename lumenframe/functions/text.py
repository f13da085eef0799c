"""Text expressions: cleaning, tokens, n-grams. Whole texts, JVM side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenframe.functions.stemming import stemmed
from lumenframe.functions.stopwords import ENGLISH

SPACES = r"[\p{Z}\x09-\x0D\x1C-\x1F\x{85}]+"
WORDS = r"[\p{L}\p{N}_]{2,}"


def cleaned_tokens(text: str | Column, stopwords: Sequence[str] = ENGLISH, longer_than: int = 2) -> Column:
    """Tags out, lower case, letters only, split, stop words and short words out."""
    raw = F.col(text) if isinstance(text, str) else text
    plain = F.lower(F.regexp_replace(raw, r"<[^>]+>", " "))
    letters = F.regexp_replace(F.regexp_replace(plain, SPACES, " "), r"[^a-z ]", "")
    words = F.split(letters, " +")
    return F.filter(words, lambda t: (F.length(t) > longer_than) & ~t.isin(*stopwords))


def cleaned(text: str | Column, stopwords: Sequence[str] = ENGLISH, stem: bool = True) -> Column:
    """Cleaned text as one string, stemmed unless ``stem`` is off."""
    tokens = cleaned_tokens(text, stopwords)
    return F.array_join(stemmed(tokens) if stem else tokens, " ")


def word_tokens(text: str | Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    raw = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(F.lower(raw), F.lit(WORDS), F.lit(0))
    return F.filter(words, lambda t: ~t.isin(*stopwords)) if stopwords else words


def bigrams(tokens: Column) -> Column:
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def one_and_two_grams(tokens: Column) -> Column:
    return F.concat(tokens, bigrams(tokens))
