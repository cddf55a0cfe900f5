"""Language-model scores by an interpolated modified Kneser-Ney bigram model.

Tasks count the bigrams of their part, which Spark shuffles as packed arrays by the context's hash; each shard's counts
become sorted hash arrays in the shared folder. A second shuffle by word gives counts and continuation counts. Workers
memory-map the arrays and look up the distinct words and bigrams of a batch. No count is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, carried, mix, texts
from millrace.llm.store import mapped, put
from millrace.plans.scratch import scratch_path

#: Tokens that a task counts before it hands its counts on.
HELD_TOKENS = 4_000_000
#: Bytes of counts that a merging task holds before it sums them.
MERGED_BYTES = 32 << 20
START, END = np.uint64(0x5F6E3C1D2B4A7988), np.uint64(0x1B873593CC9E2D51)  # hashes of the marks around a text
_LOW = np.uint64((1 << 48) - 1)


class Ids(dict):
    """Words numbered from 2; 0 starts and 1 ends a text."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 2
        return n

    def hashes(self) -> np.ndarray:
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in self), np.uint64, len(self))
        return np.concatenate([np.array([START, END], np.uint64), words])


def tokens(text: bytes, ids: Ids) -> np.ndarray:
    """0, the words' numbers, 1."""
    words = text.lower().split()
    out = np.empty(len(words) + 2, np.int64)
    out[0], out[-1] = 0, 1
    out[1:-1] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    return out


def _pairs(parts: list[np.ndarray]) -> np.ndarray:
    """Bigrams within each text, as (first << 32 | second)."""
    return np.concatenate([p[:-1] << 32 | p[1:] for p in parts]) if parts else np.zeros(0, np.int64)


def _slot(h: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(h) >> np.uint64(48)) * np.uint64(shards)) >> np.uint64(16)


def bigram_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Upper 16 bits by the first word, so that a shard is a range of hashes."""
    return (mix(first) & ~_LOW) | (mix(first * np.uint64(0x9E3779B97F4A7C15) + mix(second)) & _LOW)


_PACKED = "shard int, a binary, b binary, c binary, d binary"


def _packed(shard: int, *arrays: np.ndarray) -> tuple:
    return (shard, *(x.tobytes() for x in arrays))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], ["shard", "a", "b", "c", "d"])


def _counted(shards: int):
    """Packed bigram counts of a part: (contexts, followers each, followers, counts) by shard."""

    def pack(parts: list[np.ndarray], ids: Ids) -> pa.RecordBatch:
        keys, counts = np.unique(_pairs(parts), return_counts=True)
        h = ids.hashes()
        first, second = h[keys >> 32], h[keys & 0xFFFFFFFF]
        slot = _slot(first, shards)
        order = np.lexsort((second, first, slot))
        first, second, counts, slot = first[order], second[order], counts[order].astype(np.uint32), slot[order]
        rows = []
        edges = np.searchsorted(slot, np.arange(shards + 1, dtype=np.uint64))
        for s, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if i < j:
                starts = np.flatnonzero(np.r_[True, first[i + 1 : j] != first[i : j - 1]])
                rows.append(_packed(s, first[i:j][starts], np.diff(np.r_[starts, j - i]).astype(np.uint32), second[i:j], counts[i:j]))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = Ids(), [], 0
        for batch in batches:
            for text in texts(batch.column("text")):
                parts.append(tokens(text, ids))
                held += len(parts[-1])
                if held >= HELD_TOKENS:
                    yield pack(parts, ids)
                    ids, parts, held = Ids(), [], 0
        if parts:
            yield pack(parts, ids)

    return run


Counts = tuple[tuple[np.ndarray, ...], list[np.ndarray]]


def _by_shard(batches: Iterator[pa.RecordBatch], unpack: Callable[[list[tuple]], Counts]) -> Iterator[tuple[int, Counts]]:
    """Summed counts of one shard after another; the rows come sorted by shard.

    Rows are summed whenever `MERGED_BYTES` of them are held, or as much as the sums so far take, so a task holds a
    shard's distinct keys and not what every counting task says about a frequent word.
    """
    now, rows, held, limit, sums = None, [], 0, MERGED_BYTES, None

    def merged() -> Counts:
        keys, values = unpack(rows)
        if sums is not None:
            keys = tuple(np.concatenate(x) for x in zip(sums[0], keys))
            values = [np.concatenate(x) for x in zip(sums[1], values)]
        return _sums(keys, values)

    for batch in batches:
        for shard, *arrays in zip(*(batch.column(n).to_pylist() for n in ("shard", "a", "b", "c", "d"))):
            if shard != now and rows:
                yield now, merged()
                rows, held, limit, sums = [], 0, MERGED_BYTES, None
            now = shard
            if held >= limit:
                sums = merged()
                rows, held, limit = [], 0, max(MERGED_BYTES, sum(x.nbytes for x in (*sums[0], *sums[1])))
            rows.append(arrays)
            held += sum(map(len, arrays))
    if rows:
        yield now, merged()


def _bigram_rows(rows: list[tuple]) -> Counts:
    first = np.concatenate([np.repeat(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint32)) for a, b, _, _ in rows])
    second = np.concatenate([np.frombuffer(c, np.uint64) for _, _, c, _ in rows])
    return (second, first), [np.concatenate([np.frombuffer(d, np.uint32) for *_, d in rows]).astype(np.int64)]


def _word_rows(rows: list[tuple]) -> Counts:
    word, uses, contexts = (np.concatenate([np.frombuffer(r[k], t) for r in rows]) for k, t in enumerate((np.uint64, np.int64, np.int64)))
    return (word,), [uses, contexts]


def _sums(keys: tuple[np.ndarray, ...], values: list[np.ndarray]) -> Counts:
    """Distinct keys (last is primary) and sums of the values."""
    order = np.lexsort(keys)
    keys = tuple(k[order] for k in keys)
    new = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
    return tuple(k[new] for k in keys), [np.add.reduceat(v[order].astype(np.int64), new) for v in values]


def _merged(folder: str, shards: int):
    """Write a shard's bigrams and contexts; hand on each follower's count and number of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, ((second, first), (count,)) in _by_shard(batches, _bigram_rows):
            starts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
            several = [np.add.reduceat((count == 1).astype(np.int64), starts), np.add.reduceat((count == 2).astype(np.int64), starts), np.add.reduceat((count > 2).astype(np.int64), starts)]
            order = np.argsort(first[starts])
            put(f"{folder}/contexts-{shard}", first[starts][order])
            put(f"{folder}/totals-{shard}", np.column_stack([np.add.reduceat(count, starts), *several])[order])
            (word,), (uses, contexts) = _sums((second,), [count, np.ones(len(second), np.int64)])
            keys = bigram_hash(first, second)
            order = np.argsort(keys)
            count = count[order]
            put(f"{folder}/bigrams-{shard}", keys[order])
            put(f"{folder}/small-{shard}", np.minimum(count, 255).astype(np.uint8))
            put(f"{folder}/large-{shard}", count[count >= 255])
            out = [_packed(-1, np.array([*((count == k).sum() for k in (1, 2, 3, 4)), shard], np.int64), *[np.zeros(0)] * 3)]
            slot = _slot(word, shards)
            order = np.argsort(slot, kind="stable")
            word, uses, contexts = word[order], uses[order], contexts[order]
            edges = np.searchsorted(slot[order], np.arange(shards + 1, dtype=np.uint64)).tolist()
            out += [_packed(s, word[i:j], uses[i:j], contexts[i:j], np.zeros(0)) for s, (i, j) in enumerate(zip(edges, edges[1:])) if i < j]
            yield _batch(out)

    return run


def _words(folder: str):
    """Write a shard's word counts; hand on totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list[pa.RecordBatch] = []

        def words() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                plain = pc.less(batch.column("shard"), 0)
                totals.append(batch.filter(plain))
                yield batch.filter(pc.invert(plain))

        for shard, ((word,), (uses, contexts)) in _by_shard(words(), _word_rows):
            put(f"{folder}/words-{shard}", word)
            put(f"{folder}/uses-{shard}", np.column_stack([uses, contexts]))
            sums = np.array([len(word), uses.sum(), contexts.sum(), *((contexts == k).sum() for k in (1, 2, 3, 4))], np.int64)
            yield _batch([_packed(shard, sums, *[np.zeros(0)] * 3)])
        yield from totals

    return run


def discounts(n: np.ndarray) -> list[float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen 1, 2, 3 and 4 times; kept inside (0, k)."""
    n1, n2, n3, n4 = (max(float(x), 1.0) for x in n)
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.1), k - 0.1) for k, d in zip((1, 2, 3), raw)]


@dataclass
class Model:
    """What a worker needs besides the mapped arrays."""

    folder: str
    shards: int
    vocabulary: int
    tokens: int
    bigrams: int
    discount: list[float]
    lower: list[float]
    lower_rest: float
    worded: frozenset[int]  # shards that hold words
    followed: frozenset[int]  # shards that hold contexts and bigrams


def learn(docs: DataFrame, text: str = "text") -> Model:
    """Count `docs`, write the arrays, return the model."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder, shards = scratch_path(spark, "ngrams"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.mapInArrow(_counted(shards), _PACKED)
    merged = counted.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_merged(folder, shards), _PACKED)
    worded = merged.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_words(folder), _PACKED)
    totals = worded.select("shard", "a").collect()  # two short rows for each shard
    seen = [np.frombuffer(r.a, np.int64) for r in totals if r.shard < 0]
    words = [np.frombuffer(r.a, np.int64) for r in totals if r.shard >= 0]
    sums = np.sum(words, axis=0) if words else np.zeros(7, np.int64)
    lower = discounts(sums[3:7])
    more = max(int(sums[0] - sums[3] - sums[4]), 0)
    rest = (lower[0] * sums[3] + lower[1] * sums[4] + lower[2] * more) / sums[2] if sums[2] else 1.0
    n = np.sum(seen, axis=0)[:4] if seen else np.zeros(4, np.int64)
    worded, followed = frozenset(r.shard for r in totals if r.shard >= 0), frozenset(int(x[4]) for x in seen)
    return Model(folder, shards, int(sums[0]), int(sums[1]), int(sums[2]), discounts(n), lower, float(rest), worded, followed)


class Tables:
    """The mapped arrays of a model, shard by shard as they are needed."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def _get(self, name: str, shard: int, kind: str) -> np.ndarray:
        key = (name, shard)
        if key not in self.open:
            # No training text has a word or context of the other shards; a file that was written and is gone raises.
            written = shard in (self.model.worded if name in ("words", "uses") else self.model.followed)
            self.open[key] = mapped(f"{self.model.folder}/{name}-{shard}", kind) if written else np.zeros(0, kind)
        return self.open[key]

    def _lookup(self, hashes: np.ndarray, slots: np.ndarray, keys: str, read) -> None:
        """read(shard, positions in the shard's arrays, positions in hashes) for those that are found."""
        order = np.lexsort((hashes, slots))
        edges = np.searchsorted(slots[order], np.arange(self.model.shards + 1, dtype=np.uint64)).tolist()
        for shard, (i, j) in enumerate(zip(edges, edges[1:])):
            table = self._get(keys, shard, "<u8") if i < j else ()
            if len(table):
                mine = order[i:j]
                at = np.minimum(np.searchsorted(table, hashes[mine]), len(table) - 1)
                found = table[at] == hashes[mine]
                read(shard, at[found], mine[found])

    def words(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and numbers of contexts."""
        out = np.zeros((len(h), 2), np.int64)

        def read(shard, at, mine):
            out[mine] = self._get("uses", shard, "<i8").reshape(-1, 2)[at]

        self._lookup(h, _slot(h, self.model.shards), "words", read)
        return out[:, 0], out[:, 1]

    def contexts(self, h: np.ndarray) -> np.ndarray:
        """Total, and followers seen once, twice, more often."""
        out = np.zeros((len(h), 4), np.int64)

        def read(shard, at, mine):
            out[mine] = self._get("totals", shard, "<i8").reshape(-1, 4)[at]

        self._lookup(h, _slot(h, self.model.shards), "contexts", read)
        return out

    def bigrams(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), np.int64)

        def read(shard, at, mine):
            small = self._get("small", shard, "u1")
            counts = small[at].astype(np.int64)
            big = np.flatnonzero(counts == 255)
            if len(big):
                ranks = self._ranks(shard, small)
                counts[big] = self._get("large", shard, "<i8")[np.searchsorted(ranks, at[big])]
            out[mine] = counts

        self._lookup(bigram_hash(first, second), _slot(first, self.model.shards), "bigrams", read)
        return out

    def _ranks(self, shard: int, small: np.ndarray) -> np.ndarray:
        key = ("ranks", shard)
        if key not in self.open:
            self.open[key] = np.flatnonzero(small == 255)
        return self.open[key]


def _discounted(count: np.ndarray, d: list[float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0)


def scores(model: Model, tables: Tables, documents: list[bytes]) -> list[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, score) of each text."""
    ids = Ids()
    parts = [tokens(t, ids) for t in documents]
    h = ids.hashes()
    used, spread = tables.words(h)
    context = tables.contexts(h)
    base = np.log10((used + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
    low = _discounted(spread, model.lower) / max(model.bigrams, 1) + model.lower_rest / (model.vocabulary + 1)
    keys = _pairs(parts)
    pairs, back = np.unique(keys, return_inverse=True)
    first, second = pairs >> 32, pairs & 0xFFFFFFFF
    count = tables.bigrams(h[first], h[second])
    total = context[first, 0]
    left = context[:, 1:] @ np.array(model.discount)
    p = np.where(total > 0, (_discounted(count, model.discount) + left[first] * low[second]) / np.maximum(total, 1), low[second])
    each = np.log10(p)[back]
    out, at = [], 0
    for part in parts:
        n = len(part) - 1
        out.append((n, int((used[part[1:]] > 0).sum()), float(base[part[1:]].sum()), float(each[at : at + n].sum())))
        at += n
    return out


#: Texts are scored together up to so many bytes.
SCORED_BYTES = 8_000_000


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit(""))) % 5 == 1


def language_scores(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document.

    The model learns from the rows that are not held out. A null or empty text is one end token; a null id
    counts as the empty text. Repeated rows count again in training and get the same scores. Without training rows
    base_score and score are 0. An empty table gives no rows. Words are known by 64-bit hashes.
    """
    rows = carried(docs, id, text).withColumn("held_out", held_out(F.col("doc_id")))
    model = learn(rows.where("not held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(model)
        for batch in batches:
            found, group, held = [], [], 0
            for t in texts(batch.column("text")):
                if group and held + len(t) > SCORED_BYTES:
                    found += scores(model, tables, group)
                    group, held = [], 0
                group.append(t)
                held += len(t)
            if group:
                found += scores(model, tables, group)
            cols = list(zip(*found)) if found else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            n, known, base, score = (pa.array(c, k) for c, k in zip(cols, kinds))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), n, known, pa.array([model.tokens] * len(found), pa.int64()), base, score], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
