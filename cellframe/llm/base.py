"""What the operators of this subpackage share.

Words are maximal runs of characters other than space and 0x09-0x0D. ``bytes.split`` and ``bytes.lower`` know exactly
these separators and exactly A-Z, so the Arrow paths work on UTF-8 bytes and never touch other characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """body(value), with value computed once even where body names it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Matches of a text that are placed together.
TOGETHER = 256


def placed(found: Column, gaps: Column, make, kind: str) -> Column:
    """An array of what make(i, first, last) gives for each match, all in order.

    found: the matches of a text; gaps: what stands between them, one more; first and last are the match's characters,
    last exclusive. make gives an array of kind, so that it can leave a match out. Lengths are summed in groups, groups
    before matches, so the work grows with the number of matches and not with its square.
    """
    none = F.array().cast(f"array<{kind}>")
    n = F.size(found)
    groups = F.sequence(F.lit(0), F.floor((n - 1) / TOGETHER).cast("int"))

    def summed(lengths: Column) -> Column:
        sums = F.transform(groups, lambda g: F.aggregate(F.slice(lengths, g * TOGETHER + 1, F.lit(TOGETHER)), F.lit(0), lambda acc, x: acc + x))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))
        return let(F.aggregate(sums, start, step, lambda acc: acc["starts"]), spread)

    def spread(starts: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            first = acc["at"] + F.length(F.get(gaps, i))
            last = first + F.length(F.get(found, i))
            return F.struct(last.alias("at"), F.concat(acc["spans"], make(i, first, last)).alias("spans"))

        def group(g: Column) -> Column:
            places = F.sequence(g * TOGETHER, F.least(n, (g + 1) * TOGETHER) - 1)
            return F.aggregate(places, F.struct(F.get(starts, g).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

        return F.flatten(F.transform(groups, group))

    return F.when(n > 0, let(F.transform(found, lambda x, i: F.length(x) + F.length(F.get(gaps, i))), summed)).otherwise(none)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a task makes of one at a time stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


#: Odd base of the polynomial that hashes a word's bytes, and the bytes hashed side by side.
BASE, PIECE = 0x9FB21C651E98DF25, 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_GAP = re.compile(rb"[ \t-\r]")
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64, for i < n at least."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * PIECE)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x & (2**64 - 1), np.uint64)])) for x in (BASE, pow(BASE, -1, 2**64))]
    return _POWERS[0], _POWERS[1]


def _hashed(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start in buf, and the 64-bit hash of each."""
    a = np.frombuffer(buf, np.uint8)
    up, down = _powers(len(a) + 1)
    turns = np.diff(_SPACE[a].view(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.flatnonzero(turns == -1), np.flatnonzero(turns == 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    return starts, mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _pieces(buf: bytes) -> Iterator[bytes]:
    """buf in pieces of about PIECE bytes, none of which cuts a word."""
    lo = 0
    while len(buf) - lo > 2 * PIECE and (gap := _GAP.search(buf, lo + PIECE)):
        yield buf[lo : gap.start()]
        lo = gap.start()
    yield buf[lo:]


def word_hashes(texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
    """For each text in order, the hashes of its words with A-Z in lower case. Null has no words."""
    held: list[bytes] = []
    size = 0

    def some() -> Iterator[np.ndarray]:
        starts, h = _hashed(b"\n".join(held).lower())
        ends = np.cumsum([len(x) + 1 for x in held])
        yield from np.split(h, np.searchsorted(starts, ends[:-1]))

    for text in texts:
        text = text or b""
        if len(text) > 2 * PIECE:
            if held:
                yield from some()
            held, size = [], 0
            yield np.concatenate([_hashed(x)[1] for x in _pieces(text.lower())])
            continue
        held.append(text)
        size += len(text) + 1
        if size >= PIECE:
            yield from some()
            held, size = [], 0
    if held:
        yield from some()


#: Odd multipliers of the places in a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles_at(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each place on."""
    n = len(h) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    acc = h[:n] * PLACES[0]
    for i in range(1, k):
        acc = acc + h[i : i + n] * PLACES[i % 5]
    return mixed(acc + np.uint64(k))


def shingle_set(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct k-word shingles; with fewer words, the whole sequence as one; without words, none."""
    return distinct(np.sort(shingles_at(h, min(k, len(h))))) if len(h) else np.empty(0, np.uint64)


def distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


COUNT_BITS, COUNT_CHUNK = 22, 1 << 16


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def bucket_levels(df: DataFrame, hashes) -> np.ndarray:
    """How full each of 2**22 buckets of hashes is, on a logarithmic scale: 4 MB, whatever the corpus.

    hashes(batch) yields uint64 arrays. Level 0 is an empty bucket; ten levels are a doubling. A task counts to 255 at
    most for each bucket, so that it sends 4 MB at most; tasks' counts are added up in chunks by key, so that no task
    gathers all of them.
    """
    spark = df.sparkSession

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        held: list[np.ndarray] = []

        def add() -> None:
            b = np.sort(np.concatenate(held) >> np.uint64(64 - COUNT_BITS))
            at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            counts[b[at].astype(np.int64)] += np.diff(at, append=len(b)).astype(np.uint32)
            held.clear()

        for batch in slices(batches):
            for h in hashes(batch):
                if len(h):
                    held.append(h)
                if sum(map(len, held[-1:])) > 100_000 or len(held) >= 1000:
                    add()
        if held:
            add()
        small = np.minimum(counts, 255).astype(np.uint8).reshape(-1, COUNT_CHUNK)
        used = np.flatnonzero(small.any(axis=1))
        yield pa.record_batch({"chunk": pa.array(used, pa.int32()), "counts": pa.array([small[i].tobytes() for i in used], pa.binary())})

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, b in zip(batch["chunk"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums.setdefault(i, np.zeros(COUNT_CHUNK, np.uint32))[:] += np.frombuffer(b, np.uint8)
        for i, s in sums.items():
            levels = np.minimum(255, 10 * np.log2(s + 1.0)).astype(np.uint8)
            yield pa.record_batch({"chunk": pa.array([i], pa.int32()), "counts": pa.array([levels.tobytes()], pa.binary())})

    out = np.zeros(((1 << COUNT_BITS) // COUNT_CHUNK, COUNT_CHUNK), np.uint8)
    n = max(1, min(out.shape[0], int(spark.conf.get("spark.sql.shuffle.partitions"))))
    for row in df.mapInArrow(local, "chunk int, counts binary").repartition(n, "chunk").mapInArrow(total, "chunk int, counts binary").collect():
        out[row["chunk"]] = np.frombuffer(row["counts"], np.uint8)
    return out.reshape(-1)


def hex_bucket(key_hex: Column, digits: int) -> Column:
    """The first hexadecimal digits as a number, so that buckets are ranges of the key."""
    return F.conv(F.substring(key_hex, 1, digits), 16, 10).cast("int")


def sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
