"""Language identification with a linear-chain conditional random field over words.

Words have affix, letter n-gram and lexicon features; labels are languages, with learned transitions. Training
maximises the likelihood of a bounded sample of labelled documents on the driver; prediction runs the forward-backward
algorithm over every word of every text, many chains side by side. A document's language is the label with the
largest sum of word marginals, so stretches in another language count for what they are.

Bounds: the sample has the first ``SAMPLE_CHARS`` characters of ``PER_LANGUAGE`` documents of each language, those of the
smallest hashes. Every language is learned. A chain ends after ``CHAIN`` words and a new one begins, so that memory doesn't
grow with a text; marginals differ only at such an end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cellframe.llm.base import mixed, sf_table, slices, text_bytes

PER_LANGUAGE, SAMPLE_CHARS = 120, 20_000
CHAIN, TRAIN_CHAIN = 1024, 64
#: Features are hashed; those that the sample shows fewer than LEAST times are left out.
FEATURE_BITS, LEAST = 18, 3
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Words predicted side by side, and words whose scores a worker remembers.
BATCH_WORDS, REMEMBERED = 400_000, 1 << 18
UNDETERMINED = "und"


def letters_of(word: str) -> str:
    return (word if word.isalpha() else "".join(filter(str.isalpha, word))).casefold()


def feature_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, feature) of words given by their letters, features hashed into 2 ** FEATURE_BITS.

    Of each word: itself, its affixes of 1 to 3 letters, and its bigrams and trigrams with borders.
    """
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    begin, at = end - size, np.arange(len(codes))
    left = np.repeat(end, size) - at  # letters and borders from here on
    word = np.repeat(np.arange(len(words)), size)
    own, out = [np.arange(len(words))], [np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words)) * MULTIPLIERS[0]]

    def add(kind: int, n: int, starts: np.ndarray, owners: np.ndarray) -> None:
        h = np.full(len(starts), kind, np.uint64) * MULTIPLIERS[1]
        for i in range(n):
            h = (h ^ codes[starts + i]) * MULTIPLIERS[2 + i]
        own.append(owners)
        out.append(h)

    for n in (1, 2, 3):
        long = np.flatnonzero(size >= n + 2)
        add(n, n, begin[long] + 1, long)
        add(3 + n, n, end[long] - 1 - n, long)
    for n in (2, 3):
        starts = np.flatnonzero(left >= n)
        add(5 + n, n, starts, word[starts])
    return np.concatenate(own), (mixed(np.concatenate(out)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


class Chains:
    """Chains of scored words side by side: word i of all chains that have one lies at steps[i] : steps[i + 1]."""

    def __init__(self, lengths: np.ndarray, most: int) -> None:
        """lengths: words of each text, whose words follow one another; most: words of a chain."""
        full, rest = np.divmod(lengths, most)
        self.text = np.repeat(np.arange(len(lengths)), full + (rest > 0))
        size = np.full(len(self.text), most)
        last = np.cumsum(full + (rest > 0)) - 1
        size[last[rest > 0]] = rest[rest > 0]
        order = np.argsort(-size, kind="stable")
        rank = np.empty(len(size), np.int64)
        rank[order] = np.arange(len(size))
        word_chain = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(word_chain)) - np.repeat(np.cumsum(size) - size, size)
        self.steps = np.concatenate([[0], np.cumsum(np.bincount(place))]) if len(place) else np.zeros(1, np.int64)
        self.order = np.empty(len(place), np.int64)
        self.order[self.steps[place] + rank[word_chain]] = np.arange(len(place))
        self.word_text = np.repeat(np.arange(len(lengths)), lengths)[self.order]

    def marginals(self, scores: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """Of scores in the chains' order (log, for each label): marginals, expected transitions, log likelihood base, and first marginals."""
        e = np.exp(scores - scores.max(axis=1, keepdims=True))
        a, back = np.empty_like(e), np.empty_like(e)
        p, t, norm, steps = np.exp(start - start.max()), np.exp(trans - trans.max()), 0.0, self.steps
        for i in range(len(steps) - 1):
            lo, hi = steps[i], steps[i + 1]
            x = (p if i == 0 else a[steps[i - 1] : steps[i - 1] + hi - lo] @ t) * e[lo:hi]
            z = x.sum(axis=1, keepdims=True)
            a[lo:hi] = x / z
            norm += float(np.log(z).sum())
        moves = np.zeros_like(t)
        back[:] = 1.0
        for i in range(len(steps) - 2, 0, -1):
            lo, hi, before = steps[i], steps[i + 1], steps[i - 1]
            v = e[lo:hi] * back[lo:hi]
            u = v @ t.T
            back[before : before + hi - lo] = u / u.sum(axis=1, keepdims=True)
            av = a[before : before + hi - lo]
            z = (av * u).sum(axis=1, keepdims=True)
            moves += t * ((av / z).T @ v)
        m = a * back
        m /= m.sum(axis=1, keepdims=True)
        return m, moves, norm, m[: steps[1]].sum(axis=0) if len(steps) > 1 else np.zeros(len(p))


class Model:
    def __init__(self, labels: list[str], weights: np.ndarray, start: np.ndarray, trans: np.ndarray) -> None:
        self.labels, self.weights, self.start, self.trans = labels, weights, start, trans
        self.known = np.zeros(weights.shape[1], bool)

    def rows(self, words: list[str]) -> np.ndarray:
        """Scores of words given by their letters: the sums of their features' weights; and last, the share of features
        that the sample shows."""
        parts = [np.zeros((0, len(self.labels) + 1), np.float32)]
        for lo in range(0, len(words), 20_000):
            some = words[lo : lo + 20_000]
            word, ids = feature_ids(some)
            share = np.bincount(word, self.known[ids], len(some)) / np.bincount(word, minlength=len(some))
            parts.append(np.stack([*(np.bincount(word, w[ids], len(some)) for w in self.weights), share], axis=1).astype(np.float32))
        return np.concatenate(parts)


def train(sample: list[tuple[str, str]], turns: int = 30, rate: float = 0.15, decay: float = 1e-6) -> Model | None:
    """sample: (text, label). None without labels."""
    labels = sorted({label for _, label in sample})
    if not labels:
        return None
    texts = [([x for w in text.split() if (x := letters_of(w))], labels.index(label)) for text, label in sample]
    texts = [x for x in texts if x[0]]
    vocabulary: dict[str, int] = {}
    flat = np.array([vocabulary.setdefault(w, len(vocabulary)) for ws, _ in texts for w in ws], np.int64)
    n_labels, n_words = len(labels), len(vocabulary)
    model = Model(labels, np.zeros((n_labels, 1 << FEATURE_BITS)), np.zeros(n_labels), np.zeros((n_labels, n_labels)))
    if not len(flat):
        return model
    entry_word, entry = feature_ids(list(vocabulary))
    times = np.bincount(flat, minlength=n_words)
    model.known = frequent = np.bincount(entry, times[entry_word], 1 << FEATURE_BITS) >= LEAST
    if n_labels == 1:
        return model
    entry_word, entry = entry_word[frequent[entry]], entry[frequent[entry]]
    chains = Chains(np.array([len(ws) for ws, _ in texts]), TRAIN_CHAIN)
    words, gold = flat[chains.order], np.array([y for _, y in texts])[chains.word_text]
    same = np.diag(np.bincount(gold, minlength=n_labels)).astype(float)
    first = np.bincount(gold[: chains.steps[1]], minlength=n_labels).astype(float)
    same -= np.diag(first)
    params = [model.weights, model.start, model.trans]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    one = np.eye(n_labels)[gold]
    for turn in range(1, turns + 1):
        scores = np.stack([np.bincount(entry_word, w[entry], n_words) for w in model.weights], axis=1)
        marg, moves, _, begin = chains.marginals(scores[words], model.start, model.trans)
        by_word = [np.bincount(words, d, n_words) for d in (one - marg).T]
        by_feature = np.stack([np.bincount(entry, d[entry_word], 1 << FEATURE_BITS) for d in by_word])
        for i, (p, g) in enumerate(zip(params, (by_feature, first - begin, same - moves), strict=True)):
            g = g / len(flat) - decay * p
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            p += rate * (m[i] / (1 - 0.9**turn)) / (np.sqrt(v[i] / (1 - 0.99**turn)) + 1e-9)
    return model


class Scorer:
    """Languages of many texts; remembers the scores of words that it has met."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.scores = np.zeros((1, len(model.labels) + 1), np.float32)  # row 0: words without letters

    def _ids(self, words: list[str]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.scores, new = {}, self.scores[:1], list(set(words))
        bare: dict[str, int] = {}  # words that differ in case or in other characters share a row
        for w in new:
            self.known[w] = bare.setdefault(x, len(self.scores) + len(bare)) if (x := letters_of(w)) else 0
        if bare:
            self.scores = np.vstack([self.scores, self.model.rows(list(bare))])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def labelled(self, texts: list[bytes | None]) -> Iterator[tuple[str, float, float]]:
        """(label, score, share of known features) of each text, in order."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            words = (text or b"").decode(errors="replace").split()
            held.append(words)
            size += len(words)
            if size >= BATCH_WORDS:
                yield from self._some(held)
                held, size = [], 0
        yield from self._some(held)

    def _some(self, texts: list[list[str]]) -> Iterator[tuple[str, float, float]]:
        ids = self._ids([w for ws in texts for w in ws])
        lettered = ids > 0
        n = len(texts)
        lengths = np.array([len(ws) for ws in texts], np.int64)
        text_of = np.repeat(np.arange(n), lengths)[lettered]
        chains = Chains(np.bincount(text_of, minlength=n) if len(text_of) else np.zeros(n, np.int64), CHAIN)
        if not len(text_of):
            yield from ((UNDETERMINED, 0.0, 0.0) for _ in range(n))
            return
        scores = self.scores[ids[lettered][chains.order]]
        known = np.bincount(chains.word_text, scores[:, -1], n)
        marg = chains.marginals(scores[:, :-1], self.model.start.astype(np.float32), self.model.trans.astype(np.float32))[0]
        sums = np.stack([np.bincount(chains.word_text, marg[:, k], n) for k in range(marg.shape[1])], axis=1)
        best, totals = sums.argmax(axis=1), sums.sum(axis=1)
        for i in range(n):
            yield (self.model.labels[best[i]], *(min(1.0, float(x / totals[i])) for x in (sums[i, best[i]], known[i]))) if totals[i] > 0 else (UNDETERMINED, 0.0, 0.0)


def learned(docs: DataFrame) -> Model | None:
    """A model of every language that has a document with an id and a letter, from documents whose crc32(doc_id) mod 4 is not 2.

    The first SAMPLE_CHARS characters of PER_LANGUAGE documents of each language train it; of shorter languages, all. The
    documents first by md5 are taken: a bound on their hash leaves eight times as many as needed, and these are ranked.
    """
    span = F.substring(F.col("text").cast("string"), 1, SAMPLE_CHARS)
    docs = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), span.alias("text"))
    docs = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    md5 = F.md5(F.concat_ws("|", F.lit("sample"), F.col("doc_id").cast("string")))
    part = F.conv(F.substring("rank", 1, 8), 16, 10).cast("double") / float(1 << 32)
    counts = F.broadcast(docs.groupBy("lang").count())
    few = docs.select("doc_id", "lang", md5.alias("rank")).join(counts, "lang").where(part * F.col("count") <= 8 * PER_LANGUAGE)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id"))
    ids = few.select("doc_id", "lang", "rank").distinct().withColumn("place", place).where(F.col("place") <= PER_LANGUAGE).select("doc_id", "lang")
    some = docs.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    return train([(r["text"], r["lang"]) for r in some.orderBy("doc_id", "lang").toLocalIterator()])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, mod 4, is 2; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def language_id(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with `lang_pred`, `score` (0 to 1): the best label's share of the word marginals, and `known_share` (0 to 1).

    known_share is the share of a word's features that the training sample shows, on average over words; it is low
    for text in none of the learned languages, however many there are, and high for text that mixes some of them.
    Texts that are null or have no letter get `und` and 0; so do all if nothing could be learned. Whole texts count.
    Columns of docs that clash with the new ones are replaced; others are carried. Rows that repeat get equal results.
    """
    new = ("lang_pred", "score", "known_share")
    docs = docs.drop(*new)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(new[0], StringType()), StructField(new[1], DoubleType()), StructField(new[2], DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        scorer = Scorer(model) if model is not None else None
        for batch in slices(batches):
            texts = text_bytes(batch["text"])
            got = list(scorer.labelled(texts)) if scorer else [(UNDETERMINED, 0.0, 0.0)] * len(texts)
            cols = [*batch.columns, *(pa.array([x[i] for x in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64())))]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *new])

    return docs.mapInArrow(run, schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sf_table(spark, sf_dir, "documents")
    model = learned(docs)
    out = language_id(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "known_share")
