"""Operator 12: fill-in-the-middle by machine words.

A text is cut at line ends into prefix, middle and suffix. Its UTF-8 bytes are seen as 64-bit words; the
bytes that end a unit are marked in all eight lanes by arithmetic, ``bitwise_count`` gives the units of
each word, and the k-th end is found by a binary search of the cumulative counts and a select in the
word. No list of units is made. Code points are counted the same way, by marks on their first bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import append_struct, fresh, texts_of

#: Marks of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
_ONES = np.uint64(0x0101010101010101)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)

RESULT = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


def as_words(text: bytes) -> np.ndarray:
    """The bytes as little-endian 64-bit words, filled up with zero bytes."""
    return np.frombuffer(text + bytes(-len(text) % 8), dtype="<u8")


def byte_marks(words: np.ndarray, byte: int) -> np.ndarray:
    """The high bit of every byte that equals ``byte``; carries never leave a lane."""
    apart = words ^ (_ONES * np.uint64(byte))
    return ~(((apart & _LOW) + _LOW) | apart) & _HIGH


def char_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that does not go on a code point (not 10xxxxxx)."""
    return (~words | (words << np.uint64(1))) & _HIGH


def char_count(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.bitwise_count(char_marks(as_words(text))).sum()) - (-len(text) % 8)


class Units:
    """The units of a text that end with ``end`` (the last one may lack it)."""

    def __init__(self, text: bytes, end: int = 0x0A) -> None:
        self._text, self._marks = text, byte_marks(as_words(text), end)
        self._upto = np.cumsum(np.bitwise_count(self._marks), dtype=np.int64)
        self._ends = int(self._upto[-1]) if len(text) else 0
        self.n = self._ends + (len(text) > 0 and text[-1] != end)

    def after(self, k: int) -> int:
        """The byte offset after the first ``k`` units."""
        if k <= 0:
            return 0
        if k > self._ends:
            return len(self._text)
        at = int(np.searchsorted(self._upto, k))
        marks = int(self._marks[at])
        for _ in range(k - 1 - (int(self._upto[at - 1]) if at else 0)):
            marks &= marks - 1
        return 8 * at + ((marks & -marks).bit_length() + 7) // 8


@dataclass(frozen=True)
class Settings:
    seed: int = 7
    #: Of 100 texts, those that are transformed, and of these those with the suffix in front.
    rate: int = 100
    suffix_first: int = 50
    sentinels: Sequence[str] = SENTINELS
    end: int = 0x0A

    def __post_init__(self) -> None:
        marks = self.sentinels
        overlap = any(b.startswith(a[k:]) for a in marks for b in marks for k in range(1, len(a)))
        if len(set(marks)) != 3 or overlap or not all(marks) or any(a in b for a in marks for b in marks if a != b):
            raise ValueError("sentinels have to be three texts that cannot overlap")
        if not 0 < self.end < 0x80:
            raise ValueError("units end with an ASCII character other than NUL")


def infilled(key: str, text: bytes, settings: Settings) -> dict[str, Any]:
    """The fields of ``RESULT`` for one text; ``key`` decides places and form."""
    said = hashlib.sha256(f"{settings.seed}:{key}".encode()).hexdigest()
    h = [int(said[k : k + 8], 16) for k in range(0, 32, 8)]
    units = Units(text, settings.end)
    prefix_mark, suffix_mark, middle_mark = marks = [m.encode() for m in settings.sentinels]
    if not text or any(m in text for m in marks) or h[2] % 100 >= settings.rate:
        return {"n": units.n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text.decode()}
    first, last = (units.after(k) for k in sorted(x % (units.n + 1) for x in h[:2]))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    spm = h[3] % 100 < settings.suffix_first
    parts = (suffix_mark, suffix, prefix_mark, prefix) if spm else (prefix_mark, prefix, suffix_mark, suffix)
    return {
        "n": units.n,
        "form": "spm" if spm else "psm",
        "prefix_chars": char_count(prefix),
        "middle_chars": char_count(middle),
        "output": b"".join((*parts, middle_mark, middle)).decode(),
    }


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()
) -> tuple[DataFrame, str]:
    """``docs`` and a struct column (its name is returned) of ``RESULT``: units, form, sizes and output.

    A null text counts as empty; empty texts and those that contain a sentinel stay plain, and plain ones have
    null sizes. A null id decides like the empty id, equal ids and texts give equal outputs. A text of any
    length takes a few times its bytes of memory. An empty table gives no rows.
    """
    name, key = fresh("infill", docs.columns), fresh("_key", docs.columns)
    keyed = docs.withColumn(key, F.coalesce(F.col(doc_id).cast("string"), F.lit("")))

    def run(batch: pa.RecordBatch) -> list[dict[str, Any]]:
        pairs = zip(batch.column(key).to_pylist(), texts_of(batch, text), strict=True)
        return [infilled(k, t, settings) for k, t in pairs]

    return append_struct(keyed, run, name, RESULT).drop(key), name


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text from which ``output`` was made."""
    prefix_mark, suffix_mark, middle_mark = sentinels
    body = F.substring_index(output, middle_mark, 1)
    middle = F.substring_index(output, middle_mark, -1)
    # Before the middle stand two marks; what follows each of them up to the other one (or the end) is its part.
    prefix = F.substring_index(F.substring_index(body, prefix_mark, -1), suffix_mark, 1)
    suffix = F.substring_index(F.substring_index(body, suffix_mark, -1), prefix_mark, 1)
    return F.when(form == "plain", output).otherwise(F.concat(prefix, middle, suffix))
