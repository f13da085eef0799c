"""Operator 1: secret scans with column expressions only (no Python on the executors).

Three base patterns (an assigned credential, an access key id, a long hexadecimal run) and, beyond
them, a sliding window of Shannon entropy: over every run of one character class (``hex``, ``base64``)
that is long enough, the entropy of each window follows from that of the window before by one
character entering and one leaving. Runs that the allow-list knows are not reported; of those, the parts between
slashes are scanned by themselves.

Positions without a position function: the pieces between the matches and the matches themselves
both come from one pattern, so their lengths add up to the start of every match.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import fresh, whole

# The base patterns and the characters a match needs at least.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 12
# Maximal runs of 18 (16) and more: what is left of the shorter pattern once shorter matches are dropped.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "(?<![0-9a-f])[0-9a-f]{16,}+"

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")


@dataclass(frozen=True)
class CharClass:
    """A character class: its runs are scanned by windows of ``window`` characters.

    A window is hot when its entropy reaches ``bits``; the reported span goes from the start of the
    first hot window to the end of the last one.
    """

    kind: str
    alphabet: str
    members: str
    window: int
    bits: float


HEX_CLASS = CharClass("entropy_hex", "0123456789abcdefABCDEF", "[0-9a-fA-F]", 24, 3.05)
BASE64_CLASS = CharClass(
    "entropy_base64",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
    "[A-Za-z0-9+/_-]",
    24,
    3.95,
)
CLASSES = (HEX_CLASS, BASE64_CLASS)

#: Runs matching one of these (case-insensitively, anywhere) are known to be harmless.
ALLOW = (
    "^[^0-9]*$",  # no digit: a word, a path, a rule
    "^[^A-Za-z]*$",  # no letter: a number
    "example|sample|dummy|placeholder|changeme|xxxx",
    "0123456789|abcdefghijkl|0{8}|1{8}",
    "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUID
)

_SCALE = 1 << 20


def _cells(window: int) -> list[int]:
    """c * log2(c) for c = 0 .. window in whole units, so that adding and taking away leaves no error."""
    return [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, window + 1)]


def entropy_limit(window: int, bits: float) -> int:
    """A window is hot when its sum of c * log2(c) is at most this."""
    return math.floor(window * (math.log2(window) - bits) * _SCALE)


def _long_array(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _matches(text: Column, pattern: str, value_group: int) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.arrays_zip(pieces.alias("piece"), found.alias("found"), values.alias("value"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["piece"])
        end = start + F.length(part["found"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")))
        return F.when(part["found"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["out"], one).alias("out"))
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda s: s["out"])).otherwise(empty)


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end")
        ),
    )


def _hot_range(run: Column, cls: CharClass) -> Column:
    """struct<first, last>: the starts of the first and last hot window of a run; null if none is hot."""
    cells, limit = _long_array(_cells(cls.window)), F.lit(entropy_limit(cls.window, cls.bits))
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(cls.alphabet), c))
    size = F.length(run)

    def step(state: Column, at: Column) -> Column:
        comes = F.element_at(state["codes"], at)
        goes = F.when(at > cls.window, F.element_at(state["codes"], F.greatest(at - cls.window, F.lit(1))))
        comes_n = F.element_at(state["counts"], comes)
        without = F.when(
            goes.isNotNull(),
            F.element_at(cells, F.element_at(state["counts"], goes) + 1)
            - F.element_at(cells, F.element_at(state["counts"], goes)),
        ).otherwise(F.lit(0).cast("long"))
        held = F.when(goes == comes, comes_n - 1).otherwise(comes_n)
        total = state["total"] - without + F.element_at(cells, held + 2) - F.element_at(cells, held + 1)
        counts = F.transform(
            state["counts"],
            lambda n, i: n
            + F.when(i + 1 == comes, F.lit(1)).otherwise(F.lit(0))
            - F.when(i + 1 == goes, F.lit(1)).otherwise(F.lit(0)),
        )
        hot = (at >= cls.window) & (total <= limit)
        here = (at - cls.window).cast("int")
        return F.struct(
            state["codes"].alias("codes"),
            counts.alias("counts"),
            total.alias("total"),
            F.when(hot & state["first"].isNull(), here).otherwise(state["first"]).alias("first"),
            F.when(hot, here).otherwise(state["last"]).alias("last"),
        )

    start = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), size),
        start,
        step,
        lambda s: F.when(s["first"].isNotNull(), F.struct(s["first"].alias("first"), s["last"].alias("last"))),
    )


def _entropy_spans(text: Column, cls: CharClass, allow: Sequence[str], base: Column) -> Column:
    runs = _matches(text, f"(?<!{cls.members}){cls.members}{{{cls.window},}}+", 0)

    def harmless(value: Column) -> Column:
        said = F.lit(False)
        for pattern in allow:
            said = said | value.rlike(f"(?i){pattern}")
        return said

    def parts(run: Column) -> Column:
        """A known run is no secret, but what stands between two slashes of it may be one."""
        own = _matches(run["value"], f"(?<![^/])[^/]{{{cls.window},}}+", 0)
        moved = F.transform(
            own,
            lambda m: F.struct(
                (run["start"] + m["start"]).alias("start"), (run["start"] + m["end"]).alias("end"), m["value"].alias("value")
            ),
        )
        return F.filter(moved, lambda m: ~harmless(m["value"]))

    runs = F.flatten(F.transform(runs, lambda m: F.when(harmless(m["value"]), parts(m)).otherwise(F.array(m))))
    placed = F.transform(
        runs, lambda m: F.struct(m["start"].alias("at"), _hot_range(m["value"], cls).alias("hot"))
    )
    spans = F.transform(
        F.filter(placed, lambda p: p["hot"].isNotNull()),
        lambda p: F.struct(
            (p["at"] + p["hot"]["first"]).alias("start"),
            F.lit(KINDS.index(cls.kind)).alias("rank"),
            (p["at"] + p["hot"]["last"] + cls.window).alias("end"),
        ),
    )
    return F.filter(spans, lambda s: ~_covered(s, base))


def _covered(span: Column, base: Column) -> Column:
    """Whether the base spans, sorted by start, leave no character of the span out."""
    reached = F.aggregate(
        base,
        span["start"].cast("long"),
        lambda at, b: F.when(b["start"] <= at, F.greatest(at, b["end"])).otherwise(at),
    )
    return reached >= span["end"]


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    classes: Sequence[CharClass] = CLASSES,
    allow: Sequence[str] = ALLOW,
    base_name: str = "base_spans",
    name: str = "secret_spans",
) -> DataFrame:
    """Adds ``base_name`` and ``name``: array<struct<start, rank, end>> by start, then kind (``KINDS[rank]``).

    Start is the place of the match's first character, end is exclusive, both in code points. A base
    span is the whole match. Entropy spans that base spans cover are left out; one that reaches further stays, so
    spans may overlap. A null or empty text has no spans; ties in start are ordered by kind. Rows are
    independent of each other: no shuffle, repeated rows give repeated results, an empty table an empty one.
    """
    base_col, all_col = fresh(base_name, docs.columns), fresh(name, docs.columns)
    value = whole(text)
    assign = F.filter(_matches(value, ASSIGN, 2), lambda m: F.length(m["value"]) >= ASSIGN_LEAST)
    parts = [
        _spans(assign, "assign"),
        _spans(_matches(value, ACCESS, 0), "access"),
        _spans(_matches(value, HEX, 0), "hex"),
    ]
    based = docs.withColumn(base_col, F.array_sort(F.concat(*parts)))
    more = [_entropy_spans(value, cls, allow, F.col(base_col)) for cls in classes]
    return based.withColumn(all_col, F.array_sort(F.concat(F.col(base_col), *more)))


def span_text(spans: str | Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with each stretch of (possibly overlapping) spans replaced by ``mask``."""

    def step(state: Column, s: Column) -> Column:
        gap = F.greatest(s["start"] - state["at"], F.lit(0).cast("long"))
        piece = F.substring(text, (state["at"] + 1).cast("int"), gap.cast("int"))
        apart = s["start"] >= state["at"]
        return F.struct(
            F.when(apart, F.concat(state["out"], piece, F.lit(mask))).otherwise(state["out"]).alias("out"),
            F.greatest(s["end"], state["at"]).alias("at"),
        )

    def finish(state: Column) -> Column:
        return F.concat(
            state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text).cast("int"))
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))
