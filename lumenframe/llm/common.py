"""Small helpers shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
#: Lower-cases A-Z, nothing else.
LOWERED = bytes.maketrans(_UPPER, _LOWER)
#: The same, and every ASCII byte but letters and digits becomes a space.
LETTERS = bytes(
    b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else (b + 32 if 0x41 <= b <= 0x5A else 0x20)
    for b in range(256)
)
#: ASCII white space: what ``bytes.split()`` splits at.
SPACE_PATTERN = "[ \\x09-\\x0D]+"


def blank_words(text: bytes) -> list[bytes]:
    """Lower-cased runs without ASCII white space."""
    return text.translate(LOWERED).split()


def letter_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and any non-ASCII characters."""
    return text.translate(LETTERS).split()


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER.decode(), _LOWER.decode())


def whole(text: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_of(key: str | Column) -> Column:
    """crc32 of a key as text; a null key counts as the empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def crc_of_bytes(values: bytes) -> int:
    return zlib.crc32(values)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name`` with underscores in front until no column (in any case) has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def append_struct(
    df: DataFrame, fn: Callable[[pa.RecordBatch], list[dict[str, Any]]], name: str, schema: T.StructType
) -> DataFrame:
    """Adds the struct column ``name`` with one dict per row; all columns of ``df`` pass unchanged.

    ``fn`` gets the Arrow batch and returns a dict (the fields of ``schema``) for each of its rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = pa.array(fn(batch), type=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, added], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, schema)]))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
