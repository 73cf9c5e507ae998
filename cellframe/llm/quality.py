"""Quality rules: a table of thresholds compiled into one projection over native expressions.

Each rule names a measure of the text and the range in which it passes. A text is kept if it passes the base and every
rule. There is no shuffle and no user function; each text is measured where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import SPACES, let, sf_table, words_of

SYMBOLS = "#*$%&|<>"
#: Bits of a sort key that hold the place of a word; the others hold a hash.
PLACE_BITS = 24


class Rule(NamedTuple):
    """Passes where least <= measure <= most; a missing bound is open; a null measure passes."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Very frequent words of the languages served (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "with", "on", "be", "by",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "en", "du", "pour", "dans", "est",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "im", "sich", "auf",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "para", "su", "al", "lo", "como", "o",
)

#: Production thresholds.
RULES = (
    Rule("length", "n_words", least=50, most=10_000_000),
    Rule("mean_word_chars", "mean_word_chars", least=2, most=15),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_words", least=2),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("short_lines", "short_line_ratio", most=0.95),
    Rule("repeated_words", "repeat_ratio", most=0.5),
)


def repeat_words(words: Column, place_bits: int = PLACE_BITS) -> Column:
    """Words in 3-word windows that stand twice or more in the text.

    One native sort brings equal windows together; starts of repeated windows, in order, then cover up to three words
    each. The sort key is a long of a window's hash bits and place. Neighbours with equal hash bits are compared word by
    word; if any two differ, or places need more bits, windows are sorted once more by their words, so that the count
    is exact for every text.
    """
    size = F.size(words)
    mask = F.lit((1 << place_bits) - 1).cast("long")

    def window(ws: Column, i: Column) -> list[Column]:
        return [F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)]

    def total(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))), F.lit(0), lambda acc, x: acc + x)

    def covered(keys: Column, equal: Column, place) -> Column:
        """equal: for each key but the last, whether the next is the same window."""

        def starts(eq: Column) -> Column:
            hit = F.filter(keys, lambda _, i: F.coalesce(F.get(eq, i - 1), F.lit(False)) | F.coalesce(F.get(eq, i), F.lit(False)))
            return F.sort_array(F.transform(hit, place))

        return let(equal, lambda eq: let(starts(eq), total))

    def by_hash(ws: Column) -> Column:
        """Null if windows that differ have equal hash bits."""

        def place(key: Column) -> Column:
            return key.bitwiseAND(mask).cast("int")

        def equal(ks: Column) -> Column:
            def step(k: Column, i: Column) -> Column:
                after = F.get(ks, i + 1)
                same = F.lit(True)
                for x, y in zip(window(ws, place(k)), window(ws, place(after)), strict=True):
                    same = same & (x == y)
                return F.when(F.shiftright(k, place_bits) != F.shiftright(after, place_bits), 0).when(same, 1).otherwise(2)

            return F.transform(F.slice(ks, 1, F.size(ks) - 1), step)

        keys = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.shiftleft(F.xxhash64(*window(ws, i)), place_bits).bitwiseOR(i.cast("long")))
        return let(F.sort_array(keys), lambda ks: let(equal(ks), lambda eq: F.when(~F.array_contains(eq, 2), covered(ks, F.transform(eq, lambda x: x == 1), place))))

    def by_words(ws: Column) -> Column:
        def key(i: Column) -> Column:
            return F.struct(F.xxhash64(*window(ws, i)).alias("hash"), *[w.alias(f"w{j}") for j, w in enumerate(window(ws, i))], i.alias("place"))

        def equal(ks: Column) -> Column:
            same = lambda k, after: (k["hash"] == after["hash"]) & (k["w0"] == after["w0"]) & (k["w1"] == after["w1"]) & (k["w2"] == after["w2"])
            return F.transform(F.slice(ks, 1, F.size(ks) - 1), lambda k, i: same(k, F.get(ks, i + 1)))

        return let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(ws) - 3), key)), lambda ks: covered(ks, equal(ks), lambda k: k["place"]))

    exact = F.coalesce(F.when(size <= 1 << place_bits, by_hash(words)), by_words(words))
    return F.when(size >= 3, exact).otherwise(0).cast("long")


def measures(text: Column) -> Column:
    """A struct of all measures of a text; null is a text without words."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(words, lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"),
        repeat_words(ws).alias("n_repeat_words"),
        F.size(F.array_intersect(ws, F.array(*map(F.lit, STOP_WORDS)))).cast("double").alias("stop_words"),
    ))
    by_line = let(lines, lambda ls: F.struct(
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(ls, lambda x: F.length(x) < 3)).cast("long").alias("n_short_lines"),
    ))
    return F.struct(
        counts.alias("w"), by_line.alias("l"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )


def compiled(rules: Sequence[Rule]) -> Column:
    """One boolean: whether a row with the measures' columns passes every rule."""
    tests = []
    for rule in rules:
        value = F.col(rule.measure).cast("double")
        tests += [F.coalesce(value >= float(rule.least), F.lit(True))] if rule.least is not None else []
        tests += [F.coalesce(value <= float(rule.most), F.lit(True))] if rule.most is not None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def judged(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs with the measures, base_failed and kept.

    Null and empty texts have no words and fail the base. Whole texts are measured. Rows are independent, so repeated
    rows get equal results and an empty table an empty result; columns that clash with the new ones are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")
    docs = docs.drop(*names)
    m = docs.withColumn("__m", measures(F.col("text").cast("string")))
    n_words, n_lines = F.col("__m.w.n_words"), F.col("__m.l.n_lines")
    rows = m.select(
        *docs.columns, n_words.alias("n_words"), "__m.word_chars", "__m.n_symbols", F.col("__m.l.n_dup_lines").alias("n_dup_lines"),
        F.col("__m.w.n_repeat_words").alias("n_repeat_words"), F.col("__m.w.stop_words").alias("stop_words"),
        F.try_divide(F.col("__m.word_chars"), n_words).alias("mean_word_chars"), F.try_divide(F.col("__m.n_symbols"), F.col("__m.word_chars")).alias("symbol_ratio"),
        F.try_divide(F.col("__m.l.n_dup_lines"), n_lines).alias("dup_line_ratio"), F.try_divide(F.col("__m.l.n_short_lines"), n_lines).alias("short_line_ratio"),
        F.try_divide(F.col("__m.w.n_repeat_words"), n_words).alias("repeat_ratio"),
    )
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    failed = F.array_compact(F.array(*[F.when(~compiled([r]), F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    rows = rows.withColumns({"kept": ~F.col("base_failed") & compiled(rules), "failed_rules": F.array_join(failed, ",")})
    return rows.select(*docs.columns, *names)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(sf_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), t AS (SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM t) WHERE c > 1
), c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(list_filter(list_distinct(w), lambda x: x IN ({_STOP}))) AS stop_words,
    len(ls) AS n_lines, len(list_filter(ls, lambda x: length(x) < 3)) AS n_short
  FROM d JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [
    CASE WHEN n_words < 50 OR n_words > 10000000 THEN 'length' END,
    CASE WHEN word_chars / nullif(n_words, 0) < 2 OR word_chars / nullif(n_words, 0) > 15 THEN 'mean_word_chars' END,
    CASE WHEN n_symbols / nullif(word_chars, 0) > 0.1 THEN 'symbols' END,
    CASE WHEN stop_words < 2 THEN 'stop_words' END,
    CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.5 THEN 'repeated_lines' END,
    CASE WHEN n_short / nullif(n_lines, 0) > 0.95 THEN 'short_lines' END,
    CASE WHEN n_repeat_words / nullif(n_words, 0) > 0.5 THEN 'repeated_words' END] AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(list_filter(failed, lambda x: x IS NOT NULL)) = 0 AS kept, array_to_string(list_filter(failed, lambda x: x IS NOT NULL), ',') AS failed_rules
FROM f
"""
