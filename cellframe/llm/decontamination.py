"""Benchmark decontamination: documents that hold a benchmark item, whole or nearly so.

Each item is compared with windows of its own number of words. A window's SimHash is taken over its weighted 5-word
shingles; an index of eight 8-bit blocks finds every item whose fingerprint is within the radius, since of ``RADIUS``
differing bits some block has at most ``RADIUS // 8``; then the weighted Jaccard similarity of whole shingle multisets
decides. Windows that share no shingle with any item, and items that share none with a text, have similarity 0 there, and
are passed over before fingerprinting.

Documents are never shuffled. Items go to the tasks in blocks of ``BLOCK``; a benchmark of more items takes a pass over the
documents for each block. Weights are counted over the whole benchmark, so verdicts do not depend on blocks or order; what is
sent of them is 16 bytes for each shingle that two items or more hold.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import bucket_of, sf_table, shingles_at, slices, text_bytes, word_hashes

K = 5
SIMILARITY = 0.75
#: Of 64 bits. At similarity 0.75 about 12 bits differ, with a deviation of 3.
RADIUS = 24
BLOCKS = 8
#: Items sent to the tasks at once.
BLOCK = 20_000
#: Window starts fingerprinted at once, and pairs of windows and items compared at once.
SPAN, PAIRS = 4096, 1 << 20


class Weights:
    """log1p(items / holders) of shingles, over a whole benchmark; what no item holds weighs as much as what one holds."""

    def __init__(self, items: int, shared: np.ndarray, holders: np.ndarray) -> None:
        """shared: the shingles of two holders or more."""
        order = np.argsort(shared)
        self.shared, self.weights = shared[order], np.log1p(items / holders[order].astype(float))
        self.other = float(np.log1p(items))

    def of(self, s: np.ndarray) -> np.ndarray:
        if not len(self.shared):
            return np.full(len(s), self.other)
        at = np.minimum(np.searchsorted(self.shared, s), len(self.shared) - 1)
        return np.where(self.shared[at] == s, self.weights[at], self.other)


class ItemIndex:
    """The items of one block: their shingles, and fingerprints by size."""

    def __init__(self, items: list[tuple[int, bytes]], weights: Weights) -> None:
        self._weigh = weights.of
        self.ids, self.sizes, shingles = [], [], []
        for (item, _), h in zip(items, word_hashes(text for _, text in items), strict=True):
            if len(h):
                self.ids.append(item)
                self.sizes.append(len(h))
                shingles.append(shingles_at(h, min(K, len(h))))
        self.ks = sorted({min(K, n) for n in self.sizes})
        where = defaultdict(lambda: defaultdict(set))
        for i, s in enumerate(shingles):
            for x in s.tolist():
                where[x][self.sizes[i]].add(i)
        self.known = np.array(sorted(where), np.uint64)
        self.holders = [dict(where[x]) for x in self.known.tolist()]  # by size
        self.filled = np.zeros(1 << 22, bool)
        self.filled[bucket_of(self.known)] = True
        self.by_size = {}
        for n in set(self.sizes):
            at = [i for i, m in enumerate(self.sizes) if m == n]
            prints = np.array([self._prints(shingles[i], np.zeros(1, int), len(shingles[i]))[0] for i in at], np.uint64)
            own = prints.view(np.uint8).reshape(-1, 8)
            near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= RADIUS // BLOCKS
            self.by_size[n] = (np.array(at), prints, [near[:, own[:, b]] for b in range(BLOCKS)])
        self.multisets = [self._multiset(s) for s in shingles]

    def _multiset(self, s: np.ndarray) -> tuple[dict[int, int], float]:
        values, counts = np.unique(s, return_counts=True)
        return dict(zip(values.tolist(), counts.tolist(), strict=True)), float((self._weigh(values) * counts).sum())

    def _prints(self, s: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """SimHash of s[start : start + length] for each start."""
        bits = np.unpackbits(np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64) * 2 - 1
        sums = np.vstack([np.zeros((1, 64)), np.cumsum(bits * self._weigh(s)[:, None], axis=0)])
        return np.packbits(sums[starts + length] - sums[starts] > 1e-9, axis=1).view(np.uint64).reshape(-1)

    def similarity(self, item: int, window: np.ndarray) -> float:
        mine, total = self.multisets[item]
        values, counts = np.unique(window, return_counts=True)
        w = self._weigh(values)
        common = np.minimum(counts, [mine.get(x, 0) for x in values.tolist()])
        both = float((w * common).sum())
        union = float((w * counts).sum()) + total - both
        return both / union if union else 0.0

    def found(self, h: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """item: (similarity, first word, differing bits) of its best window, for items found in a text of these words."""
        out: dict[int, tuple[float, int, int]] = {}
        for k in self.ks:
            s = shingles_at(h, k)
            seeds = np.flatnonzero(self.filled[bucket_of(s)]) if len(s) else []
            if not len(seeds):
                continue
            at = np.minimum(np.searchsorted(self.known, s[seeds]), len(self.known) - 1)
            hit = self.known[at] == s[seeds]
            places, sharing = defaultdict(list), defaultdict(set)
            for p, x in zip(seeds[hit].tolist(), at[hit].tolist(), strict=True):
                for n, some in self.holders[x].items():
                    if min(K, n) == k:
                        places[n].append(p)
                        sharing[n] |= some
            for n, ps in places.items():
                length = min(n, len(h)) - k + 1
                ends = np.zeros(len(s) + 1, np.int64)  # windows that hold a seed start within length - 1 places before it
                np.add.at(ends, np.maximum(0, np.array(ps) - length + 1), 1)
                np.add.at(ends, np.array(ps) + 1, -1)
                starts = np.flatnonzero(np.cumsum(ends)[: len(s) - length + 1])
                self._match(s, starts, length, n, sorted(sharing[n]), out)
        return out

    def _match(self, s: np.ndarray, starts: np.ndarray, length: int, n: int, items: list[int], out: dict[int, tuple[float, int, int]]) -> None:
        """Puts the best window of each of items, all of size n, into out: the most similar, the nearest, the first."""
        every, prints, blocks = self.by_size[n]
        part = np.searchsorted(every, items)
        for i in range(0, len(part), PAIRS):  # a block's items fit one turn; a larger BLOCK takes more
            some = part[i : i + PAIRS]
            self._near(s, starts, length, every[some], prints[some], [b[:, some] for b in blocks], out)

    def _near(self, s: np.ndarray, starts: np.ndarray, length: int, items: np.ndarray, prints: np.ndarray, blocks: list[np.ndarray], out: dict[int, tuple[float, int, int]]) -> None:
        at, most = 0, max(1, PAIRS // len(items))
        while at < len(starts):
            lo = starts[at]
            to = min(int(np.searchsorted(starts, lo + SPAN)), at + most)
            some = starts[at:to]
            seen = self._prints(s[lo : some[-1] + length], some - lo, length)
            own = seen.view(np.uint8).reshape(-1, 8)
            near = np.zeros((len(some), len(items)), bool)
            for b in range(BLOCKS):
                near |= blocks[b][own[:, b]]
            w, i = np.nonzero(near)
            apart = np.bitwise_count(seen[w] ^ prints[i])
            keep = apart <= RADIUS
            w, i, apart = w[keep], i[keep], apart[keep]
            for j in np.argsort(apart, kind="stable").tolist():
                item, start = int(items[i[j]]), int(some[w[j]])
                best, first, bits = out.get(item, (0.0, 0, 0))
                if best == 1.0:
                    continue
                sim, differ = self.similarity(item, s[start : start + length]), int(apart[j])
                if sim >= SIMILARITY and (sim, -differ, -start) > (best, -bits, -first):
                    out[item] = (sim, start, differ)
            at = to


def _weights(items: DataFrame) -> Weights:
    """Items and holders of shingles, counted by Spark; only shared shingles reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            held = [np.unique(shingles_at(h, min(K, len(h)))).view(np.int64) for h in word_hashes(text_bytes(batch["text"])) if len(h)]
            flat = np.concatenate(held) if held else np.zeros(0, np.int64)
            yield pa.record_batch([pa.concat_arrays([pa.array(flat), pa.nulls(len(held), pa.int64())])], names=["shingle"])  # a null for each item

    counts = items.select("text").mapInArrow(run, "shingle long").groupBy("shingle").count().where("shingle IS NULL OR count > 1").toArrow()
    shingles, n = counts["shingle"], counts["count"].to_numpy()
    none = np.array(shingles.is_null())
    shared = shingles.fill_null(0).to_numpy()[~none].astype(np.int64).view(np.uint64)
    return Weights(int(n[none].sum()), shared, n[~none])


def _blocks(items: DataFrame) -> Iterator[ItemIndex]:
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id IS NOT NULL AND text IS NOT NULL")
    weights = _weights(rows)
    held: list[tuple[int, bytes]] = []
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        held.append((row[0], row[1].encode()))
        if len(held) == BLOCK:
            yield ItemIndex(held, weights)
            held = []
    if held:
        yield ItemIndex(held, weights)


def contaminated_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, hamming: each document and each item that it holds, at its best window.

    Whole texts are searched. A document shorter than an item is one window. Null and empty texts hold nothing, and
    items without words are in nothing; items of fewer than five words count as one shingle. Rows that repeat are
    reported each; equal items are each reported. Other columns are ignored. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, similarity double, first_word long, hamming int"
    out = None
    for index in _blocks(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in slices(batches):
                rows = []
                for doc, h in zip(batch["doc_id"].to_pylist(), word_hashes(text_bytes(batch["text"])), strict=True):
                    for i, (sim, start, apart) in index.found(h).items():
                        rows.append((doc, index.ids[i], sim, start, apart))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int32()), strict=True)], names=["doc_id", "item_id", "similarity", "first_word", "hamming"])

        found = docs.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, columns as before; texts stay where they are."""
    for index in _blocks(items):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in slices(batches):
                yield batch.filter(pa.array([not index.found(h) for h in word_hashes(text_bytes(batch["text"]))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it holds."""
    return contaminated_passages(sf_table(spark, sf_dir, "documents"), sf_table(spark, sf_dir, "benchmark"))
