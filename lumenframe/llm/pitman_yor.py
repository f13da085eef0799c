"""Operator 3: language-model scores from a hierarchical Pitman-Yor model.

Every training token is a customer in the restaurant of its context, the word before it hashed to one of
2^16 restaurants; all of them share one parent restaurant, whose base is uniform over the words and one
unknown. A sweep of the sampler seats the customers of every (context, word) anew, given the tables
everywhere else after the sweep before, so all cells of a sweep are independent of each other and any number
of tasks can share them. A table opened in a context restaurant sends a customer to the parent. Predictive
probabilities are averaged over the sweeps after the first.

Tokens are counted block by block next to their documents. A block sends each shard (a share of the
words) its occurrences, 4 bytes each, and the distinct words; that is the only shuffle of the corpus. It is
written once and read by every sweep. What goes between the sweeps has a fixed size: tables per restaurant and
a few totals. Very frequent words, found on a sample, are spread over all shards by their contexts; their
totals are added up between the sweeps. The sample decides only where a word is counted, not what is counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.llm.common import blank_words, crc_of, texts_of, whole
from lumenframe.session import checkpoint

FOLDS = 10
SLOTS = 1 << 16
SWEEPS = 3
BURN_IN = 1
CONCENTRATION = 1.0
BLOCK_TOKENS = 1_000_000
_BLOCK_DOCS = 1 << 15
#: Bytes of text whose words make a shard.
SHARD_BYTES = 16 << 20
#: A word with more than one in so many tokens of the sample is spread over all shards.
HOT_SHARE = 2048
HOT_SAMPLE_DOCS = 500
_END = np.uint64(xxhash.xxh64_intdigest(b"\x00end"))
_START = np.uint64(xxhash.xxh64_intdigest(b"\x00start"))
_MIX = np.uint64(0x9E3779B97F4A7C15)

PAYLOAD = "shard int, block long, first binary, second binary, third binary"
_NAMES = ["shard", "block", "first", "second", "third"]


def token_hashes(text: bytes) -> np.ndarray:
    """A hash for each word, then one for the end."""
    words = blank_words(text)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.append(hashes, _END)


def _slots(tokens: np.ndarray) -> np.ndarray:
    before = np.concatenate([[_START], tokens[:-1]]).astype(np.uint64)
    return ((before * _MIX) >> np.uint64(48)).astype(np.uint32)


def _shard_of(words: np.ndarray, slots: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    own = (words >> np.uint64(8)) % np.uint64(shards)
    if not len(hot):
        return own.astype(np.int64)
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return np.where(hot[at] == words, (own + slots) % np.uint64(shards), own).astype(np.int64)


def block_rows(
    tokens: list[np.ndarray], ids: list[int | None], train: list[bool], block: int, shards: int, hot: np.ndarray
) -> Iterator[tuple]:
    """A block's payload: for each shard its distinct words, how often each occurs, and the occurrences.

    An occurrence holds its context (16 bits), whether it is for training (1) and its document (15).
    """
    sizes = np.array([len(t) for t in tokens])
    known = np.array([i is not None for i in ids])
    about = np.stack([np.array([i or 0 for i in ids], dtype=np.int64), sizes, known, np.array(train)])
    yield -1 - block % shards, block, about.astype(np.int64).tobytes(), b"", b""
    words = np.concatenate(tokens)
    slots = np.concatenate([_slots(t) for t in tokens])
    low = np.arange(len(ids), dtype=np.uint32) | (np.array(train, dtype=np.uint32) << np.uint32(15))
    entries = slots << np.uint32(16) | np.repeat(low, sizes)
    shard = _shard_of(words, slots, shards, hot)
    order = np.lexsort((entries, words, shard))
    words, entries, shard = words[order], entries[order], shard[order]
    begins = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (shard[1:] != shard[:-1])]))
    counts = np.diff(np.append(begins, len(words))).astype(np.uint32)
    distinct, of_shard = words[begins], shard[begins]
    cuts = np.flatnonzero(np.concatenate([[True], of_shard[1:] != of_shard[:-1]]))
    for a, b in zip(cuts, np.append(cuts[1:], len(begins)), strict=True):
        upto = begins[b] if b < len(begins) else len(words)
        yield int(of_shard[a]), block, distinct[a:b].tobytes(), counts[a:b].tobytes(), entries[begins[a] : upto].tobytes()


def _blocks(shards: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        tokens, ids, train, held = [], [], [], 0

        def written() -> pa.RecordBatch:
            nonlocal tokens, ids, train, held, number
            rows = list(zip(*block_rows(tokens, ids, train, number, shards, hot), strict=True))
            tokens, ids, train, held, number = [], [], [], 0, number + 1
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(rows, kinds, strict=True)], names=_NAMES
            )

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "train"))
            for doc, learns, text in zip(*columns, texts_of(batch, "text"), strict=True):
                tokens.append(token_hashes(text))
                ids.append(doc)
                train.append(learns)
                held += len(tokens[-1])
                if held >= BLOCK_TOKENS or len(ids) == _BLOCK_DOCS:
                    yield written()
        if ids:
            yield written()

    return run


class Totals(NamedTuple):
    """What every shard has to know of the others after a sweep."""

    tables: np.ndarray  # of each context restaurant
    parent_customers: float
    parent_tables: float
    hot_customers: np.ndarray  # of the spread words in the parent
    hot_tables: np.ndarray


class Corpus(NamedTuple):
    """Fixed totals of the training tokens."""

    customers: np.ndarray  # of each context restaurant
    tokens: float
    vocabulary: float
    discount: float
    parent_discount: float
    hot: np.ndarray
    hot_counts: np.ndarray


def seat(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating ``customers`` of one dish each; ``opening`` is the weight of a new table.

    A customer joins one of the t tables of i earlier customers with weight i - discount * t. The first 64 sit
    down one by one, later ones in lots of a sixteenth of those seated.
    """
    tables = (customers > 0).astype(np.float64)
    live = np.flatnonzero(customers > 1)
    live = live[np.argsort(-customers[live], kind="stable")]
    left = customers[live]
    i = 1
    while len(live):
        lot = 1 if i < 64 else i // 16
        chance = opening[live] / (opening[live] + i - discount * tables[live])
        chance = np.clip(chance, 0, 1)
        new = rng.random(len(live)) < chance if lot == 1 else rng.binomial(np.minimum(lot, left - i).astype(np.int64), chance)
        tables[live] += new
        i += lot
        n = int(np.searchsorted(-left, -i, side="left"))  # those with more than i customers
        live, left = live[:n], left[:n]
    return tables


class Shard:
    """The cells (context, word) of one shard and their seating, repeated from the same random numbers."""

    def __init__(self, number: int, rows: list[tuple], corpus: Corpus | None, hot: np.ndarray) -> None:
        self.number, self.corpus, self.hot = number, corpus, hot
        words = [np.frombuffer(r[2], dtype=np.uint64) for r in rows]
        self.words = np.unique(np.concatenate(words))
        self.blocks = []
        keys = []
        for (_, block, _, counts, entries), own in zip(rows, words, strict=True):
            word_at = np.searchsorted(self.words, own).astype(np.uint64)
            held = (block, word_at, np.frombuffer(counts, dtype=np.uint32), np.frombuffer(entries, dtype=np.uint32))
            self.blocks.append(held)
            keys.append(self.keys_of(*held[1:])[(held[3] & 0x8000) > 0])
        self.keys, self.counts = np.unique(np.concatenate(keys), return_counts=True)
        del keys
        self.counts = self.counts.astype(np.float64)
        self.word, self.slot = self.keys >> 16, self.keys & 0xFFFF
        self.hot_at = np.full(len(self.words), -1)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, self.words), len(hot) - 1)
            self.hot_at = np.where(hot[at] == self.words, at, -1)

    @staticmethod
    def keys_of(word_at: np.ndarray, counts: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """The cell of each occurrence of a block: place of its word, then its context."""
        return (np.repeat(word_at, counts) << np.uint64(16) | (entries >> np.uint32(16))).astype(np.int64)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=values, minlength=len(self.words))

    def shared(self, own: np.ndarray, all_shards: np.ndarray) -> np.ndarray:
        """Per word: its sum here, or over all shards where the word is spread."""
        if not len(all_shards):
            return own
        return np.where(self.hot_at >= 0, all_shards[self.hot_at], own)

    def parent(self, customers: np.ndarray, tables: np.ndarray, t: Totals) -> np.ndarray:
        """The parent's probability of each word, and of a new one at the end."""
        c = self.corpus
        rest = (CONCENTRATION + c.parent_discount * t.parent_tables) / (c.vocabulary + 1)
        kept = np.append(customers - c.parent_discount * tables, 0.0)
        return (kept + rest) / (CONCENTRATION + t.parent_customers)

    def sweeps(self, history: list[Totals], upto: int, seed: int) -> Iterator[tuple]:
        """(tables of the cells, parent customers and tables of the words) after sweeps 0 .. ``upto``."""
        c, tables = self.corpus, np.ones(len(self.keys))
        own = self.by_word(tables)
        seated = (own > 0).astype(np.float64)
        yield tables, own, seated
        for g in range(1, upto + 1):
            t = history[g - 1]
            rng = np.random.default_rng([seed, g, self.number])
            customers = self.shared(own, t.hot_customers)
            prob = self.parent(customers, self.shared(seated, t.hot_tables), t)
            opening = (CONCENTRATION + c.discount * t.tables[self.slot]) * prob[self.word]
            tables = seat(self.counts, opening, c.discount, rng)
            own = self.by_word(tables)
            base = (CONCENTRATION + c.parent_discount * t.parent_tables) / (c.vocabulary + 1)
            seated = seat(own, np.full(len(own), base), c.parent_discount, rng)
            yield tables, own, seated


# Places in the vector of totals.
_TABLES, _CUSTOMERS = 0, SLOTS
_SCALARS = 2 * SLOTS  # parent customers, parent tables, words, cells of 1 and 2 tokens, words of 1 and 2 cells
_HOT = _SCALARS + 7


def _totals_of(shard: Shard, tables: np.ndarray, own: np.ndarray, seated: np.ndarray, counting: bool) -> np.ndarray:
    h = len(shard.hot)
    out = np.zeros(_HOT + 2 * h)
    out[:SLOTS] = np.bincount(shard.slot, weights=tables, minlength=SLOTS)
    cold = shard.hot_at < 0
    scalars = [own[cold].sum(), seated[cold].sum()]
    if counting:
        out[_CUSTOMERS:_SCALARS] = np.bincount(shard.slot, weights=shard.counts, minlength=SLOTS)
        scalars += [(own[cold] > 0).sum(), *((shard.counts == k).sum() for k in (1, 2)), *((own[cold] == k).sum() for k in (1, 2))]
        counts = shard.by_word(shard.counts)
        np.add.at(out, _HOT + h + shard.hot_at[~cold], counts[~cold])
    out[_SCALARS : _SCALARS + len(scalars)] = scalars
    np.add.at(out, _HOT + shard.hot_at[~cold], own[~cold])
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for number, held in groupby(rows, key=lambda r: r[0]):
        yield number, held


def _pass(corpus: Corpus | None, hot: np.ndarray, history: list[Totals], sweep: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_HOT + 2 * len(hot))
        for number, rows in _shards(batches):
            if number >= 0:
                shard = Shard(number, list(rows), corpus, hot)
                *_, last = shard.sweeps(history, sweep, seed)
                total += _totals_of(shard, *last, counting=corpus is None)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "value"])

    return run


def _summed(rows: DataFrame, corpus, hot, history, sweep: int, seed: int) -> np.ndarray:
    """Totals of all shards: as many numbers as there are restaurants and spread words, whatever the input."""
    parts = rows.mapInArrow(_pass(corpus, hot, history, sweep, seed), "at long, value double")
    table = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(_HOT + 2 * len(hot))
    out[table.column("at").to_numpy()] = table.column("value").to_numpy()
    return out


def _discount(once: float, twice: float) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice) if once else 0.5))


def _scored(corpus: Corpus, history: list[Totals], sweeps: int, burn_in: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(block, kind, first, second=b"", third=b"", fourth=b""):
            out.append({"block": block, "kind": kind, "a": first, "b": second, "c": third, "d": fourth})

        for number, rows in _shards(batches):
            out: list[dict] = []
            if number < 0:
                for _, block, about, _, _ in rows:
                    row(block, 0, about)
                    if len(out) >= 100:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out = []
            else:
                shard = Shard(number, list(rows), corpus, corpus.hot)
                counts = shard.shared(shard.by_word(shard.counts), corpus.hot_counts)
                base = np.log10((counts + 0.1) / (corpus.tokens + 0.1 * (corpus.vocabulary + 1)))
                samples = []
                for g, (tables, own, seated) in enumerate(shard.sweeps(history, sweeps, seed)):
                    if g > burn_in or g == sweeps:
                        t = history[g]
                        prob = shard.parent(shard.shared(own, t.hot_customers), shard.shared(seated, t.hot_tables), t)
                        kept = np.append(shard.counts - corpus.discount * tables, 0.0)
                        samples.append((kept, prob, CONCENTRATION + corpus.discount * t.tables))
                for block, word_at, n, entries in shard.blocks:
                    key, doc = shard.keys_of(word_at, n, entries), entries & 0x7FFF
                    at = np.minimum(np.searchsorted(shard.keys, key), max(len(shard.keys) - 1, 0))
                    seen = shard.keys[at] == key if len(shard.keys) else np.zeros(len(key), dtype=bool)
                    at = np.where(seen, at, len(shard.keys))
                    word, slot = key >> 16, key & 0xFFFF
                    p = sum(kept[at] + rest[slot] * prob[word] for kept, prob, rest in samples)
                    p = np.log10(p / (len(samples) * (CONCENTRATION + corpus.customers[slot])))
                    docs, which = np.unique(doc, return_inverse=True)
                    sums = [np.bincount(which, weights=v, minlength=len(docs)) for v in (p, base[word], counts[word] > 0)]
                    row(block, 1, docs.astype(np.uint16).tobytes(), *(s.tobytes() for s in sums))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    kinds = {"block": pa.int64(), "kind": pa.int32(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary(), "d": pa.binary()}
    schema = pa.schema(kinds)
    return run


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _gathered(train_tokens: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        about = frame[frame["kind"] == 0]
        ids, sizes, known, train = np.frombuffer(about["a"].iloc[0], dtype=np.int64).reshape(4, -1)
        sums = np.zeros((3, len(ids)))
        # Shards in the order of their bytes, so that a repeated task adds up in the same order.
        for r in frame[frame["kind"] == 1].sort_values(["b", "c"]).itertuples():
            docs = np.frombuffer(r.a, dtype=np.uint16)
            sums[:, docs] += np.stack([np.frombuffer(v) for v in (r.b, r.c, r.d)])
        out = {
            "doc_id": pd.Series(ids).where(pd.Series(known) > 0).astype("Int64"),
            "held_out": train == 0,
            "n_tokens": sizes,
            "n_known": sums[2].astype(np.int64),
            "train_tokens": train_tokens,
            "base_score": sums[1],
            "score": sums[0],
        }
        return pd.DataFrame(out)

    return run


def _hot_words(docs: DataFrame, sample: int) -> np.ndarray:
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample).distinct()
    rows = docs.join(F.broadcast(ids), "doc_id").select("text")  # ``sample`` ids at most

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in texts_of(batch, "text"):
                words, n = np.unique(token_hashes(text), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

    counts = rows.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r["word"] for r in counts.where(F.col("n") * HOT_SHARE > total).collect()]  # < HOT_SHARE words
    return np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sweeps: int = SWEEPS,
    burn_in: int = BURN_IN,
    seed: int = 1,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Documents whose crc32(id as text) mod 10 is 0 are held out. ``base_score`` is the unigram log10 probability
    with 0.1 added to each count, ``score`` the model's; 10 ** (-score / n_tokens) is the perplexity. A null
    or empty text is its end token. A null id counts as the empty text, so it is held out. Repeated rows are
    scored (and learned from) once each; without training documents every word is unknown. An empty table
    gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        whole(text).alias("text"),
        (F.pmod(crc_of(doc_id), F.lit(FOLDS)) != 0).alias("train"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    hot = _hot_words(rows, HOT_SAMPLE_DOCS)
    payload = rows.mapInArrow(_blocks(shards, hot), PAYLOAD).repartition(shards, "shard")
    payload = checkpoint(payload.sortWithinPartitions("shard", "block"))

    first = _summed(payload, None, hot, [], 0, seed)
    h, s = len(hot), first[_SCALARS:_HOT]
    hot_cells, hot_counts = first[_HOT : _HOT + h], first[_HOT + h :]
    seated = (hot_cells > 0).astype(np.float64)
    corpus = Corpus(
        customers=first[_CUSTOMERS:_SCALARS],
        tokens=float(first[_CUSTOMERS:_SCALARS].sum()),
        vocabulary=float(s[2] + seated.sum()),
        discount=_discount(s[3], s[4]),
        parent_discount=_discount(s[5], s[6]),
        hot=hot,
        hot_counts=hot_counts,
    )
    history = [Totals(first[:SLOTS], s[0] + hot_cells.sum(), s[1] + seated.sum(), hot_cells, seated)]
    for g in range(1, sweeps + 1):
        now, before = _summed(payload, corpus, hot, history, g, seed), history[-1]
        own = now[_HOT : _HOT + h]
        base = (CONCENTRATION + corpus.parent_discount * before.parent_tables) / (corpus.vocabulary + 1)
        rng = np.random.default_rng([seed, g])
        seated = seat(own, np.full(h, base), corpus.parent_discount, rng)
        history.append(
            Totals(now[:SLOTS], now[_SCALARS] + own.sum(), now[_SCALARS + 1] + seated.sum(), own, seated)
        )
    parts = payload.mapInArrow(
        _scored(corpus, history, sweeps, burn_in, seed), "block long, kind int, a binary, b binary, c binary, d binary"
    )
    return parts.groupBy("block").applyInPandas(_gathered(int(corpus.tokens)), RESULT)
