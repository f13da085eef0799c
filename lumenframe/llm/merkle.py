"""Operator 11: a Merkle manifest of a table, with proofs and folding from kept hash states.

A leaf is the SHA-256 of a row's fields. Per group (source), the leaves in order of their ids are hashed in
runs of three, level by level, to the group's root; the group roots in order of the groups likewise give the
root of the table. Rows are numbered by ranges, so a group of any size is cut into chunks of 3^6 leaves; a
task builds one chunk at a time, and the chunk tops, 729 times fewer, are the leaves of the next round.

Every parent keeps a copy of its hash state before each of its child slots. Going down again, a chunk gets
the siblings above it once, keeps the state before its own slot at each of those levels, and a changed leaf
is folded to the root by resuming, per level, the kept state with the replacement and the right siblings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumenframe.operators.ordered import with_position
from lumenframe.session import checkpoint

FANOUT = 3
#: Levels built at once; a chunk has FANOUT ** LEVELS nodes.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The siblings of a node at one level, left and right of it, as joined hex digests.
PATH = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def joined_fields(columns: Sequence[str | Column]) -> Column:
    """Each value as ``bytes:value``, a null one as ``-``."""
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class Parent:
    """A node over up to three children: its digest, and the hash state before each child slot."""

    def __init__(self, children: Sequence[str]) -> None:
        state, self.children, self.before = hashlib.sha256(), children, []
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> dict[str, str]:
        return {"left": "".join(self.children[:slot]), "right": "".join(self.children[slot + 1 :])}


def resumed(before, replacement: str, right: str) -> str:
    """The digest of a parent whose child after the state ``before`` is replaced."""
    state = before.copy()
    state.update((replacement + right).encode())
    return state.hexdigest()


def built(nodes: Sequence[str], levels: int | None) -> list[list[Parent]]:
    """The parents of each level over ``nodes``: up to a single node, or exactly ``levels`` levels."""
    out = []
    while len(nodes) > 1 if levels is None else len(out) < levels:
        out.append([Parent(nodes[k : k + FANOUT]) for k in range(0, len(nodes), FANOUT)])
        nodes = [p.digest for p in out[-1]]
    return out


def _chunks(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[list[dict]]:
    """The rows of one (group, chunk) after another."""
    key, held = None, []
    for batch in batches:
        for row in batch.select(list(names)).to_pylist():
            now = (row["grp"], row["chunk"])
            if held and now != key:
                yield held
                held = []
            key = now
            held.append(row)
    if held:
        yield held


def _levels_of(rows: Sequence[dict], levels: int) -> int | None:
    return None if rows[0]["total"] <= FANOUT**levels else levels


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (grp, at, total, node), dealt out by chunk -> the tops of their chunks, in the same form."""
    schema = T.StructType([*nodes.select("grp", "at", "total", "node").schema.fields])
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _chunks(batches, ("grp", "chunk", "total", "node")):
            tree = built([r["node"] for r in rows], _levels_of(rows, levels))
            top = tree[-1][0].digest if tree else rows[0]["node"]
            wide = -(-rows[0]["total"] // FANOUT**levels)
            out.append({"grp": rows[0]["grp"], "at": rows[0]["chunk"], "total": wide, "node": top})
            if len(out) >= 2000:
                yield pa.RecordBatch.from_pylist(out, schema=kind)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=kind)

    return nodes.mapInArrow(run, schema)


def _in_chunks(nodes: DataFrame, levels: int, heads: DataFrame | None = None) -> DataFrame:
    """Nodes dealt out by chunk and sorted; the head of a chunk, if any, comes first."""
    rows = nodes.withColumn("chunk", F.floor(F.col("at") / FANOUT**levels).cast("long"))
    if heads is not None:
        rows = rows.unionByName(heads, allowMissingColumns=True)
    return rows.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "at")


def climbed(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of every round, lowest first, and the last one's tops: one node per group."""
    rounds = [nodes]
    while True:
        up = checkpoint(_tops(_in_chunks(rounds[-1], levels), levels))
        most = up.agg(F.max("total")).first()[0]
        if most is None or most <= 1:
            return rounds, up
        rounds.append(up)


def _descended(nodes: DataFrame, heads: DataFrame, levels: int, extra: Sequence[str] = ()) -> DataFrame:
    """Adds to each node its path to the root, the digest above it (``top``), and ``folded``.

    ``heads`` (grp, chunk, head) holds the path of each chunk's top. ``folded`` is the root recomputed from
    ``changed`` if ``nodes`` has this column and it is not null, else from the node itself.
    """
    kept = [f for f in nodes.schema.fields if f.name in ("grp", "at", "node", *extra)]
    text = T.StringType()
    added = [T.StructField("path", PATH), T.StructField("top", text), T.StructField("folded", text)]
    schema = T.StructType([*kept, *added])
    kind, names = to_arrow_schema(schema), [f.name for f in kept]
    folds = "changed" in nodes.columns
    read = [*names, "chunk", "total", "head", *(["changed"] if folds else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for first, *rows in _chunks(batches, read):
            head = first["head"]
            tree = built([r["node"] for r in rows], _levels_of(rows, levels))
            above = [(hashlib.sha256(p["left"].encode()), p["right"]) for p in head["path"]]
            for k, row in enumerate(rows):
                path, now, place = [], row.get("changed") or row["node"], k
                for level in tree:
                    place, slot = divmod(place, FANOUT)
                    path.append(level[place].siblings(slot))
                    if folds:
                        now = resumed(level[place].before[slot], now, path[-1]["right"])
                if folds:
                    for before, right in above:
                        now = resumed(before, now, right)
                path += head["path"]
                made = {"path": path, "top": head["top"], "folded": now if folds else None}
                out.append({n: row[n] for n in names} | made)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, schema=kind)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema=kind)

    return _in_chunks(nodes, levels, heads).select(*read).mapInArrow(run, schema)


def _heads(rows: DataFrame, top: str) -> DataFrame:
    """Nodes with their paths -> the heads of the chunks below them."""
    return rows.select("grp", F.col("at").alias("chunk"), F.struct("path", F.col(top).alias("top")).alias("head"))


def manifest(
    docs: DataFrame,
    doc_id: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    changed: Column | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """(doc_id, grp, leaf, path, subroot, root, folded): one row for each row of ``docs``.

    ``leaf`` is the digest of the ``fields``, ``path`` the siblings (left, right) level by level up to the
    root of the table, ``subroot`` the root of the row's group. ``changed`` is the digest of another version
    of the row (null: the row as it is); ``folded`` is the root recomputed from it and the siblings.
    Null groups and null ids are groups and ids of their own and come first; rows of one id follow each
    other by their leaf, and repeated rows are leaves of their own. Long texts are hashed once and not moved. An
    empty table gives no rows.
    """
    leaves = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(group).cast("string").alias("grp"),
        digest(joined_fields(fields)).alias("node"),
        (F.lit(None).cast("string") if changed is None else changed).alias("changed"),
    )
    leaves = checkpoint(leaves)  # sampling the ranges reads them once more
    placed = with_position(leaves, ["doc_id", "node", "changed"], by=["grp"], name="at", total="total")
    placed = checkpoint(placed.select("doc_id", "grp", "at", "total", "node", "changed"))
    rounds, subroots = climbed(placed, levels)

    groups = with_position(subroots.select(F.col("grp").alias("name"), "node"), ["name"], name="at", total="total")
    groups = checkpoint(groups.select(F.lit("").alias("grp"), "name", "at", "total", "node"))
    group_rounds, root = climbed(groups, levels)
    heads = _heads(root.select("grp", "at", F.array().cast(PATH).alias("path"), "node"), "node")
    for nodes in reversed(group_rounds):
        below = checkpoint(_descended(nodes, heads, levels, ["name"] if "name" in nodes.columns else []))
        heads = _heads(below, "top")

    heads = below.select(  # the whole tree of a group lies below its root
        F.col("name").alias("grp"),
        F.lit(0).cast("long").alias("chunk"),
        F.struct("path", F.col("node").alias("top")).alias("head"),
    )
    for nodes in reversed(rounds[1:]):
        heads = _heads(checkpoint(_descended(nodes, heads, levels)), "top")
    rows = _descended(rounds[0], heads, levels, ["doc_id"])
    whole = root.select(F.col("node").alias("root"))
    return rows.select(
        "doc_id",
        "grp",
        F.col("node").alias("leaf"),
        "path",
        F.col("top").alias("subroot"),
        whole.scalar().alias("root"),
        "folded",
    )


def proof_text(path: str | Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    path = F.col(path) if isinstance(path, str) else path
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")
