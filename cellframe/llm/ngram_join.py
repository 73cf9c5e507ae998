"""N-gram Jaccard join: all links of Jaccard similarity 0.75 or more between sets of 5-word shingles, and their classes.

A grouped prefix join. Shingles have one global order: rare ones first, by the levels of a fixed-size count table, ties
by hash. Two sets that link share one of the first ``n - ceil(0.75 n) + 1`` shingles of each. Documents whose prefix and
size are identical form one group; only groups are indexed and filtered, by shared prefix shingle, by size, and by what
two prefixes let whole sets have in common; the pairs that remain are expanded to the groups' different sets and
verified against whole sets.

Classes need connectivity, not every pair, so pairs come in rounds. In the first rounds each shared shingle proposes
only pairs with one set on its list (a star), which joins a large family of near copies with as many pairs as it has
members. The last round proposes every pair that is left between sets not yet connected. No candidate is capped
and no link between different components is lost.

Lists are read one after another, each by one task. Lists of about ``LONG`` groups or more, found by counting a hash
sample of the groups, never come together: their stars have centres found by partial aggregation, and in the last round
only what isn't in a list's largest component meets the rest, in blocks of about ``LONG`` by ``LONG`` rows. The sample
decides how a list is read, not what is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import bucket_levels, bucket_of, distinct, mixed, sf_table, shingle_set, slices, text_bytes, word_hashes
from cellframe.operators.graphs import components
from cellframe.sources.scratch import written

K = 5
#: Similarity as a fraction of whole numbers.
NUM, DEN = 3, 4
#: Groups on a list that are too many for one task, and the share of groups (one in so many) that finds such lists.
LONG, SAMPLE = 1 << 14, 16


def prefix_length(n: int) -> int:
    return n - (NUM * n + DEN - 1) // DEN + 1 if n else 0


def sets_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The sorted set of each text of a batch."""
    return (shingle_set(h, K) for h in word_hashes(text_bytes(batch["text"])))


def order_keys(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The global order: rare shingles first, ties by hash."""
    return (levels[bucket_of(s)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))


def prefix_of(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return s[np.argsort(order_keys(s, levels), kind="stable")[: prefix_length(len(s))]]


def prefixes_allow(x: np.ndarray, nx: int, y: np.ndarray, ny: int, levels: np.ndarray) -> bool:
    """Whether sets of sizes nx and ny with these prefixes can link.

    What both sets have up to the earlier of the two last prefix shingles is in both prefixes; beyond it they have no
    more in common than either has left.
    """
    kx, ky = order_keys(x, levels), order_keys(y, levels)
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    end = min(kx[-1], ky[-1])
    left = min(nx - int(np.searchsorted(kx, end)), ny - int(np.searchsorted(ky, end)))
    overlap = min(common + left, nx, ny)
    return DEN * overlap >= NUM * (nx + ny - overlap)


def _signatures(docs: DataFrame, levels) -> DataFrame:
    """doc_id, n, set_key, group_key of every document; and its prefix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        for batch in slices(batches):
            n, keys, groups, prefixes = [], [], [], []
            for s in sets_of(batch):
                prefix = prefix_of(s, table).tobytes()
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                groups.append(xxhash.xxh3_128_digest(prefix + len(s).to_bytes(8, "big")))
                prefixes.append(prefix)
            yield pa.record_batch({"doc_id": batch["doc_id"].cast(pa.int64()), "n": pa.array(n, pa.int64()), "set_key": pa.array(keys, pa.binary()), "group_key": pa.array(groups, pa.binary()), "prefix": pa.array(prefixes, pa.binary())})

    return docs.mapInArrow(run, "doc_id long, n long, set_key binary, group_key binary, prefix binary")


def _tokens(groups: DataFrame) -> DataFrame:
    """(token, gid, rest) for each shingle of each group's prefix; rest counts the set's shingles from it on."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            gids, sizes = batch["gid"].to_numpy(), batch["n"].to_pylist()
            parts = [np.frombuffer(p, np.int64) for p in batch["prefix"].to_pylist()]
            ends = np.cumsum([len(p) for p in parts])
            lo = 0
            while lo < len(parts):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 200_000)))
                rest = np.concatenate([np.arange(n, n - len(p), -1, dtype=np.int32) for n, p in zip(sizes[lo:hi], parts[lo:hi], strict=True)])
                yield pa.record_batch({"token": pa.array(np.concatenate(parts[lo:hi])), "gid": pa.array(np.repeat(gids[lo:hi], [len(p) for p in parts[lo:hi]])), "rest": pa.array(rest)})
                lo = hi

    return groups.select("gid", "n", "prefix").mapInArrow(run, "token long, gid long, rest int")


def _shared(tokens: DataFrame) -> DataFrame:
    """Rows of tokens that stand in two groups or more. Streams through sorted rows; holds one batch and one row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        shared = False
        for batch in batches:
            if not batch.num_rows:
                continue
            both = batch if held is None else pa.concat_batches([held, batch])
            t = both["token"].to_numpy()
            same = t[1:] == t[:-1]
            keep = np.zeros(len(t), bool)
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= shared
            yield both.slice(0, len(t) - 1).filter(pa.array(keep[:-1]))
            held, shared = both.slice(len(t) - 1), bool(keep[-1])
        if held is not None and shared:
            yield held

    return tokens.repartition("token").sortWithinPartitions("token", "gid").mapInArrow(run, tokens.schema)


def need(n, m):
    """Shingles that sets of these sizes must share to link; for numbers, arrays and columns."""
    return -((-NUM * (n + m)) // (NUM + DEN))


def _long_tokens(groups: DataFrame, long: int, sample: int) -> DataFrame:
    """(token, salts) of the lists that hold about `long` groups or more, by the groups of a hash sample."""
    some = groups.where(F.pmod(F.xxhash64("gid"), F.lit(sample)) == 0)
    counts = _tokens(some).groupBy("token").count().where(F.col("count") * sample >= long)
    return counts.select("token", F.ceil(F.col("count") * sample / long).cast("int").alias("salts"))


def _long_proposals(rows: DataFrame, which: str) -> DataFrame:
    """What _proposals gives, for the rows (and salts) of long lists; see there and the module's text.

    "last" pairs a row with the largest set of its own and of the next class of sizes, a factor DEN / NUM wide.
    """
    c = F.col
    band = F.floor(F.ln(c("n").cast("double")) / F.lit(math.log(DEN / NUM))).cast("int")
    if which != "all":
        by, first = (["token"], c("rest") / c("n")) if which == "centre" else (["token", "band"], c("n"))
        rows = rows.withColumn("band", band)
        hubs = rows.groupBy(*by).agg(F.max(F.struct(first.alias("first"), (-c("gid")).alias("order"), "rest", "n", "comp")).alias("hub"))
        hubs = hubs.select(*by, (-c("hub.order")).alias("hub"), c("hub.rest").alias("hub_rest"), c("hub.n").alias("hub_n"), c("hub.comp").alias("hub_comp"))
        if which == "last":
            rows = rows.withColumn("band", F.explode(F.array("band", c("band") + 1)))
        least = F.ceil(NUM * (c("n") + c("hub_n")) / F.lit(NUM + DEN))
        met = rows.join(hubs, by).where((c("comp") != c("hub_comp")) & (F.least("rest", "hub_rest") >= least))
        return met.select(F.least("gid", "hub").alias("g1"), F.greatest("gid", "hub").alias("g2")).distinct()

    # Of each list, what is in its largest component needs no pairs with one another.
    counts = rows.groupBy("token", "comp").agg(F.count("*").alias("k"), F.first("salts").alias("salts"))
    tops = counts.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("all"), F.first("salts").alias("salts")).where("top.k < all")
    share = (c("all") - c("top.k")) / c("all")
    tops = tops.select("token", c("top.comp").alias("top"), F.ceil(share * c("salts")).cast("int").alias("parts"))
    rows = rows.join(tops, "token")
    cells = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place = lambda n, seed: F.pmod(F.xxhash64("gid", F.lit(seed)), n).cast("int")
    left = rows.select("token", place(c("salts"), 1).alias("i"), cells(c("parts")).alias("j"), F.lit(False).alias("odd"), "gid", "rest", "n", "comp")
    right = rows.where("comp <> top").select("token", cells(c("salts")).alias("i"), place(c("parts"), 2).alias("j"), F.lit(True).alias("odd"), "gid", "rest", "n", "comp")

    def block(table: pa.Table) -> pa.Table:
        odd = table["odd"].to_numpy(zero_copy_only=False)
        g, rest, n, comp = (table[k].to_numpy().astype(np.int64) for k in ("gid", "rest", "n", "comp"))
        at = np.flatnonzero(~odd)
        at = at[np.argsort(n[at], kind="stable")]
        lg, lrest, ln, lcomp = g[at], rest[at], n[at], comp[at]
        found = [np.empty((2, 0), np.int64)]
        for i in np.flatnonzero(odd):
            lo, hi = np.searchsorted(DEN * ln, NUM * n[i]), np.searchsorted(NUM * ln, DEN * n[i], side="right")
            other = lo + np.flatnonzero((lcomp[lo:hi] != comp[i]) & (np.minimum(lrest[lo:hi], rest[i]) >= need(ln[lo:hi], n[i])))
            found.append(np.stack([np.minimum(lg[other], g[i]), np.maximum(lg[other], g[i])]))
        g1, g2 = np.concatenate(found, axis=1)
        return pa.table({"g1": g1, "g2": g2})

    return left.unionByName(right).groupBy("token", "i", "j").applyInArrow(block, "g1 long, g2 long").distinct()


def _proposals(rows: DataFrame, which: str) -> DataFrame:
    """Pairs of groups on the lists of shared tokens that can link and are in different components.

    rows: token, gid, rest, n, comp, sorted here by token, then n, then gid. Sets of sizes n and m link only if they
    share ``ceil(3 (n + m) / 7)`` shingles; at the first shingle that they share, both have as many from it on. So a
    pair is proposed only where both rests allow it, and a linking pair is so at its first shared shingle.
    which: "centre", each row pairs with the row of its list nearest to the front of its own set; "last", with the
    last row that its size allows; "all", with every row before it. Lists are read one after another.
    """

    def of_list(g: np.ndarray, rest: np.ndarray, n: np.ndarray, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if which == "all":
            for i in range(1, len(g)):
                lo = int(np.searchsorted(DEN * n[:i], NUM * n[i]))
                other = lo + np.flatnonzero((c[lo:i] != c[i]) & (np.minimum(rest[lo:i], rest[i]) >= need(n[lo:i], n[i])))
                if len(other):
                    yield g[other], np.full(len(other), g[i])
        else:  # the last row of at most DEN / NUM of its size
            hub = np.searchsorted(NUM * n, DEN * n, side="right") - 1
            ok = (c != c[hub]) & (np.minimum(rest, rest[hub]) >= need(n, n[hub]))
            yield g[hub[ok]], g[ok]

    def of_lists(cols: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of whole lists that lie one after another; lists of one component are passed over."""
        starts = np.concatenate([[0], np.flatnonzero(np.diff(cols[0])) + 1])
        apart = np.minimum.reduceat(cols[4], starts) != np.maximum.reduceat(cols[4], starts)
        size = np.diff(starts, append=len(cols[0]))
        _, g, rest, n, c = (x[np.repeat(apart, size)] for x in cols)
        size = size[apart]
        ends = np.cumsum(size)
        if which == "centre":
            which_list = np.repeat(np.arange(len(size)), size)
            best = np.lexsort((-rest / n, which_list))[ends - size]
            hub = np.repeat(best, size)
            ok = (c != c[hub]) & (np.minimum(rest, rest[hub]) >= need(n, n[hub]))
            yield g[hub[ok]], g[ok]
        else:
            for lo, hi in zip((ends - size).tolist(), ends.tolist(), strict=True):
                yield from of_list(g[lo:hi], rest[lo:hi], n[lo:hi], c[lo:hi])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proposed() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            held = [np.empty(0, np.int64)] * 5
            for batch in batches:
                cols = [np.concatenate([h, batch[k].to_numpy().astype(np.int64)]) for h, k in zip(held, ("token", "gid", "rest", "n", "comp"), strict=True)]
                if not len(cols[0]):
                    continue
                last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last list may go on
                if last:
                    yield from of_lists([x[:last] for x in cols])
                held = [x[last:] for x in cols]
            if len(held[0]):
                yield from of_lists(held)

        def once(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
            g1, g2 = np.minimum(a, b), np.maximum(a, b)
            at = np.lexsort((g2, g1))
            g1, g2 = g1[at], g2[at]
            new = np.concatenate([[True], (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])])
            return pa.record_batch({"g1": pa.array(g1[new]), "g2": pa.array(g2[new])})

        parts, size = [], 0
        for a, b in proposed():
            if len(a):
                parts.append((a, b))
                size += len(a)
            if len(parts) >= 20_000:
                parts = [tuple(np.concatenate(x) for x in zip(*parts, strict=True))]
            if size >= 500_000:  # only spares repeats; distinct() removes the rest
                yield once(parts)
                parts, size = [], 0
        if parts:
            yield once(parts)

    return rows.repartition("token").sortWithinPartitions("token", "n", "gid").mapInArrow(run, "g1 long, g2 long").distinct()


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and whole set of the documents in ids; a 4 MB table of hashed ids spares the others' texts."""

    def hashed(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield mixed(batch["doc_id"].to_numpy().view(np.uint64))

    maybe = docs.sparkSession.sparkContext.broadcast(bucket_levels(ids, hashed).tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(maybe.value, np.uint8)
        for batch in slices(batches):
            at = batch["doc_id"].fill_null(0).cast(pa.int64()).to_numpy()
            batch = batch.filter(pa.array(table[bucket_of(mixed(at.view(np.uint64)))] > 0))
            yield pa.record_batch({"doc_id": batch["doc_id"].cast(pa.int64()), "shingles": pa.array([s.tobytes() for s in sets_of(batch)], pa.binary())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles binary").join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def _allowed(pairs: DataFrame, groups: DataFrame, levels) -> DataFrame:
    """Pairs of groups with `near`: whether their prefixes allow a link."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        for batch in slices(batches):
            rows = zip(*(batch[c].to_pylist() for c in ("p1", "n1", "p2", "n2")), strict=True)
            near = [prefixes_allow(np.frombuffer(x, np.uint64), nx, np.frombuffer(y, np.uint64), ny, table) for x, nx, y, ny in rows]
            yield pa.record_batch({"g1": batch["g1"], "g2": batch["g2"], "near": pa.array(near, pa.bool_())})

    one, two = groups.select(F.col("gid").alias("g1"), F.col("prefix").alias("p1"), F.col("n").alias("n1")), groups.select(F.col("gid").alias("g2"), F.col("prefix").alias("p2"), F.col("n").alias("n2"))
    return pairs.join(one, "g1").join(two, "g2").select("g1", "g2", "p1", "n1", "p2", "n2").mapInArrow(run, "g1 long, g2 long, near boolean")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of documents, those whose whole sets link."""
    sets = written(_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()), "whole")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch["s1"], batch["s2"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(x) + len(y) - len(distinct(np.sort(np.concatenate([x, y]))))
                keep.append(DEN * common >= NUM * (len(x) + len(y) - common))
            at = pa.array(keep, pa.bool_())
            yield pa.record_batch({"a": batch["a"].filter(at), "b": batch["b"].filter(at)})

    one, two = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s1")), sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s2"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "s1", "s2").mapInArrow(run, "a long, b long")


def _within(now: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of one group in different components: those outside its largest one with all others."""
    counts = now.where("different > 1").groupBy("gid", "comp").agg(F.count("*").alias("k"))
    tops = counts.groupBy("gid").agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    sets = now.join(tops.select("gid", F.col("top.comp").alias("top")), "gid")
    odd = sets.where("comp <> top").select("gid", F.col("node").alias("a"), F.col("comp").alias("ca"))
    return odd.join(sets.select("gid", F.col("node").alias("b"), F.col("comp").alias("cb")), "gid").where("ca <> cb").select("a", "b")


def _joined(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, comp) after further links (a, b): only these links and the components that they join take part."""
    if comps is None:
        return written(components(links), "comps")
    if not links.limit(1).count():
        return comps
    for end in ("a", "b"):
        links = links.join(comps.toDF(end, "comp"), end, "left").withColumn(end, F.coalesce("comp", end)).drop("comp")
    more = written(components(links), "more")
    out = comps.join(more.toDF("comp", "next"), "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    return written(out.unionByName(more.join(comps.select("node"), "node", "left_anti")), "comps")


def ngram_jaccard_join(docs: DataFrame, long: int = LONG, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_shingles (long), component_id (smallest doc_id reachable by links, itself included).

    docs needs doc_id and text; other columns, whatever their names, are ignored. Null and empty texts, and texts of
    spaces alone, have an empty set and link with nothing. Rows that repeat a doc_id each get a result row. A null
    doc_id gets component null and links nothing. An empty table gives an empty result. long and sample say which lists
    of a shingle are read in parts, and do not change the result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = spark.sparkContext.broadcast(bucket_levels(docs.select("text"), sets_of).tobytes())
    signatures = _signatures(docs, levels)
    members = written(signatures.drop("prefix"), "members")
    linkable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    groups = signatures.where(linkable).groupBy("group_key").agg(F.min("doc_id").alias("gid"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = written(groups.drop("group_key"), "groups")
    tokens, heavy = _tokens(groups), None
    hot = written(_long_tokens(groups, long, sample), "hot")
    if hot.limit(1).count():
        heavy = written(tokens.join(hot, "token"), "heavy")
        tokens = tokens.join(hot, "token", "left_anti")
    shared = written(_shared(tokens), "shared")
    listed = shared.select("gid") if heavy is None else shared.select("gid").unionByName(heavy.select("gid"))
    listed = listed.distinct()

    # Sets by key, each named by its smallest document; groups by key, each named by its smallest set.
    sets = members.where(linkable).groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("group_key").alias("group_key"))
    sets = written(sets, "sets")
    named = sets.groupBy("group_key").agg(F.min("node").alias("gid"), F.count("*").alias("different"))
    nodes = sets.join(named, "group_key").select("node", "gid", "n", "different")
    candidates = written(nodes.join(listed, "gid", "left_semi").unionByName(nodes.where("different > 1")).distinct(), "nodes")
    groups = groups.join(listed, "gid", "left_semi")

    comps: DataFrame | None = None
    tested: DataFrame | None = None
    refused: DataFrame | None = None
    for which in ("centre", "last", "all"):
        now = candidates.withColumn("comp", F.col("node"))
        if comps is not None:
            now = candidates.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        # A group counts as one component only if all its sets are in it; otherwise it stays open as its own.
        state = now.groupBy("gid").agg(F.when(F.min("comp") == F.max("comp"), F.min("comp")).otherwise(F.xxhash64(F.lit("open"), "gid")).alias("comp"), F.first("n").alias("n"))
        pairs = _proposals(shared.join(state, "gid"), which)
        if heavy is not None:
            pairs = pairs.unionByName(_long_proposals(heavy.join(state, "gid"), which)).distinct()
        if refused is not None:
            pairs = pairs.join(refused, ["g1", "g2"], "left_anti")
        judged = written(_allowed(pairs, groups, levels), "judged")
        no, pairs = judged.where("NOT near").select("g1", "g2"), judged.where("near").select("g1", "g2")
        refused = no if refused is None else refused.unionByName(no)
        if which != "all":  # of each group, its first set; within a group, all sets with the first
            pairs = pairs.select(F.col("g1").alias("a"), F.col("g2").alias("b")).unionByName(now.where("node <> gid AND comp <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b")))
        else:
            left, right = now.select(F.col("gid").alias("g1"), F.col("node").alias("a"), F.col("comp").alias("ca")), now.select(F.col("gid").alias("g2"), F.col("node").alias("b"), F.col("comp").alias("cb"))
            pairs = pairs.join(left, "g1").join(right, "g2").where("ca <> cb").select("a", "b").unionByName(_within(now))
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        comps = _joined(comps, written(_verified(pairs, docs), "links"))

    named = sets.select("set_key", "node").join(comps, "node", "left").select("set_key", F.coalesce("comp", "node").alias("comp"))
    out = members.where(linkable).join(named, "set_key").select("doc_id", F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"))
    rest = members.where(~linkable | F.col("doc_id").isNull()).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(rest)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(sf_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS MATERIALIZED (SELECT doc_id, unnest(s) AS sh FROM s
), n AS MATERIALIZED (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT n.doc_id, n.n AS n_shingles, m.component_id FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = n.doc_id
"""
