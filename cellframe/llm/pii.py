"""Personal data by weak supervision, in native expressions only.

Patterns propose spans; labelers (strict pattern, gazetteer, context words, borders) vote on each or abstain.
Expectation-maximisation estimates how reliable each labeler is for each kind, from counts of vote patterns alone, and so
a probability for each pattern. With these as soft labels a span classifier (naive Bayes over votes and shape) is trained
by aggregation. Base spans, defined by exact rules, always stay; proposed spans stay if the classifier says so.

Documents are read once, by a projection without a shuffle, and only spans are kept. What reaches the driver are counts
of vote patterns and of feature values: at most kinds times 3 ** labelers, and kinds times feature values.
"""

from __future__ import annotations

import math
from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import let, placed, sf_table
from cellframe.sources.scratch import written


class Kind(NamedTuple):
    """A kind of span: what proposes it, what the strict labeler wants, known parts, and words of its context."""

    name: str
    gate: str
    pattern: str
    strict: str
    known: str
    context: str
    base: bool = False


_LOCAL = r"[A-Za-z0-9._%+-]"
#: Patterns of the base kinds equal the contract's; lookbehinds and possessive repeats only spare scans that must fail.
KINDS = (
    Kind("email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++", r"^[A-Za-z0-9][^@]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$", r"\.(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$", r"(?i)mail|contact|write|reach|kontakt|correo|courriel", True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$", r"^(?!0\.|127\.|255\.)", r"(?i)\bip\b|address|server|host|login|adresse", True),
    Kind("card", r"[0-9][ -]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++", r"^[0-9]{12,19}$|^[0-9]{4}(?:[ -][0-9]{4}){3}$", r"^(?:4|5[1-5]|2[2-7]|3[47]|6)", r"(?i)card|visa|credit|payment|karte|carte|tarjeta", True),
    Kind("phone", r"\+", r"\+[0-9][\x20().0-9-]+[0-9]", r"^\+[0-9]{1,3}[ .(-]", r"^\+(?:1|33|34|44|49|39|31|41|43|86|91|81)\b", r"(?i)phone|call|tel|mobile|fax|telefon|tél", True),
    Kind("secret", r"AKIA|ghp_|sk-|[=:]", r"AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}|(?:password|passwd|secret|token|api_?key)[\x20\x09]*[=:][\x20\x09]*[\"']?[^\x20\x09-\x0D\"']{6,}[\"']?", r"^(?:AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36})$|[=:][\x20\x09]*[\"']?[0-9A-Za-z+/_-]{8,}[\"']?$", r"^(?:AKIA|ghp_|sk-|password|token|api)", r"(?i)key|secret|token|password|login"),
    Kind("local_phone", r"[0-9]{3}[-. )]", r"(?<![0-9+)(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])", r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^[0-9]{3}-[0-9]{3}-[0-9]{4}$", r"^\(?[2-9]", r"(?i)phone|call|tel|mobile|fax"),
    Kind("national_id", r"[0-9]-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", r"^[0-7]", r"(?i)ssn|social|security|\bid\b"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?![A-Za-z0-9])", r"^[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){3,6}", r"^(?:DE|FR|ES|GB|IT|NL|CH|AT|BE)", r"(?i)iban|bank|konto|account|compte|cuenta"),
    Kind("hidden_email", r"(?i)[(\[]at[)\]]", rf"{_LOCAL}{{1,64}} ?[(\[]at[)\]] ?[A-Za-z0-9-]{{1,63}} ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z]{{2,10}}", r"^[A-Za-z0-9]", r"(?:com|org|net|edu|de|fr|es)$", r"(?i)mail|contact|write|reach"),
    Kind("name", r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur)\b", r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?", r" [A-Z][a-z]+ [A-Z][a-z]+$", r" (?:John|Mary|James|Anna|Peter|Maria|Hans|Marie|Carlos|Thomas|Michael|Laura)\b", r"(?i)dear|name|sincerely|signed|liebe|cher"),
)
LABELERS = 4
#: Characters before a span that the context labeler reads.
NEAR = 40
TURNS = 50
#: Added spans need this probability.
LEAST = 0.5

_SPAN = "struct<kind:int,first:int,last:int,base:boolean,votes:string,shape:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def step(acc: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _valid(kind: Kind, value: Column) -> Column:
    if kind.name == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind.name == "card":
        return F.length(_digits(value)).between(12, 19) & F.when(F.length(_digits(value)).between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind.name == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column) -> Column:
    return F.when(yes, "1").otherwise("0")


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind, with votes (a character for each labeler, - for none) and shape."""

    def all_of(found: Column) -> Column:
        def spans(gaps: Column) -> Column:
            def one(i: Column, first: Column, last: Column) -> Column:
                value, before, after = F.get(found, i), F.get(gaps, i), F.get(gaps, i + 1)
                border = ~F.substring(before, -1, 1).rlike("[A-Za-z0-9]") & ~F.substring(after, 1, 1).rlike("[A-Za-z0-9]")
                context = F.when(F.substring(before, -NEAR, NEAR).rlike(kind.context), "1").otherwise("-")
                votes = F.concat(_vote(value.rlike(kind.strict)), _vote(value.rlike(kind.known)), context, _vote(border))
                n = F.length(_digits(value))
                shape = F.concat_ws("|", F.least(F.length(value) / 4, F.lit(9)).cast("int"), (4 * n / F.length(value)).cast("int"), value.rlike("[A-Z]").cast("int"))
                span = F.struct(F.lit(number).alias("kind"), first.alias("first"), last.alias("last"), F.lit(kind.base).alias("base"), votes.alias("votes"), shape.alias("shape"))
                return F.when(_valid(kind, value), F.array(span)).otherwise(F.array().cast(f"array<{_SPAN}>"))

            return placed(found, gaps, one, _SPAN)

        return F.when(F.size(found) > 0, let(F.split(text, kind.pattern, -1), spans))

    return F.when(text.rlike(kind.gate), let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), all_of))


def _ordered(spans: Column) -> Column:
    key = F.transform(spans, lambda s: F.struct(s["first"].alias("first"), s["kind"].alias("kind"), s["last"].alias("last"), s["base"].alias("base"), s["votes"].alias("votes"), s["shape"].alias("shape")))
    return F.array_sort(key)


def candidates(docs: DataFrame) -> DataFrame:
    """docs' doc_id with `spans`, by start and then kind: base spans, and proposed ones that touch no base span."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    rows = docs.select("doc_id", *[F.coalesce(_spans(text, i, k), none).alias(k.name) for i, k in enumerate(KINDS)])
    base, more = F.concat(*[k.name for k in KINDS if k.base]), F.concat(*[k.name for k in KINDS if not k.base])
    rows = rows.select("doc_id", base.alias("base"), more.alias("more"))
    free = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["first"] < m["last"]) & (m["first"] < b["last"])))
    return rows.select("doc_id", _ordered(F.concat("base", free)).alias("spans"))


def estimated(counts: dict[tuple[int, str], int]) -> dict[tuple[int, str], float]:
    """For each kind and vote pattern, the probability of personal data, by expectation-maximisation.

    A two-class model for each kind: a prior, and for each labeler the chance of a yes in either class, with a weak
    belief (as of 10 votes) that labelers are right more often than not.
    """
    out: dict[tuple[int, str], float] = {}
    for kind in {k for k, _ in counts}:
        rows = [(v, n) for (k, v), n in counts.items() if k == kind]
        prior, hit, slip = 0.5, [0.8] * LABELERS, [0.2] * LABELERS
        for _ in range(TURNS):
            post = {}
            for votes, _n in rows:
                yes, no = prior, 1 - prior
                for j, v in enumerate(votes):
                    if v != "-":
                        yes *= hit[j] if v == "1" else 1 - hit[j]
                        no *= slip[j] if v == "1" else 1 - slip[j]
                post[votes] = yes / (yes + no)
            total = sum(n for _, n in rows)
            prior = (sum(n * post[v] for v, n in rows) + 1) / (total + 2)
            for j in range(LABELERS):
                cast = [(v[j] == "1", n, post[v]) for v, n in rows if v[j] != "-"]
                hit[j] = (8 + sum(n * p for y, n, p in cast if y)) / (10 + sum(n * p for _, n, p in cast))
                slip[j] = (2 + sum(n * (1 - p) for y, n, p in cast if y)) / (10 + sum(n * (1 - p) for _, n, p in cast))
        out |= {(kind, v): p for v, p in post.items()}
    return out


def _lookup(key: Column, values: dict[str, float], missing: float) -> Column:
    if not values:
        return F.lit(missing)
    table = F.create_map(*[F.lit(x) for kv in sorted(values.items()) for x in kv])
    return F.coalesce(F.element_at(table, key), F.lit(missing))


def _features(s: Column) -> Column:
    """Feature values of a span, each with the kind: votes, and the three parts of its shape."""
    parts = F.split(s["shape"], r"\|")
    kind = s["kind"].cast("string")
    return F.concat(F.array(F.concat(kind, F.lit(":v:"), s["votes"])), F.transform(parts, lambda p, i: F.concat(kind, F.lit(":"), i.cast("string"), F.lit(":"), p)))


def trained(cands: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """(log odds of each kind, log likelihood ratio of each feature value): the span classifier."""
    spans = cands.select(F.explode("spans").alias("s"))
    counts = {(r["kind"], r["votes"]): r["n"] for r in spans.groupBy("s.kind", "s.votes").agg(F.count("*").alias("n")).collect()}
    post = estimated(counts)
    by_kind: dict[int, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for (k, v), n in counts.items():
        by_kind[k][0] += n * post[k, v]
        by_kind[k][1] += n * (1 - post[k, v])
    p = _lookup(F.concat(F.col("s.kind").cast("string"), F.lit(":"), F.col("s.votes")), {f"{k}:{v}": x for (k, v), x in post.items()}, 0.5)
    soft = spans.select(F.explode(_features(F.col("s"))).alias("feature"), p.alias("p"))
    ratios = {}
    for r in soft.groupBy("feature").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).orderBy("feature").collect():
        yes, no = by_kind[int(r["feature"].split(":")[0])]
        ratios[r["feature"]] = round(math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["n"] - r["yes"] + 0.5) / (no + 1)), 6)
    return {str(k): round(math.log(y / n), 6) for k, (y, n) in by_kind.items()}, ratios


def found(docs: DataFrame) -> DataFrame:
    """doc_id and `spans` (kind name, first, last, base, score) of every document.

    first and last are code points, last exclusive; score is the classifier's probability. Null and empty texts have no
    spans; whole texts are read, however long. Rows are independent: repeated rows get equal spans. Other columns of
    docs are ignored. An empty table gives an empty result.
    """
    cands = written(candidates(docs), "spans")
    odds, ratios = trained(cands)
    names = F.array(*[F.lit("phone" if k.name == "local_phone" else "email" if k.name == "hidden_email" else k.name) for k in KINDS])

    def judged(s: Column) -> Column:
        total = _lookup(s["kind"].cast("string"), odds, 0.0) + F.aggregate(_features(s), F.lit(0.0), lambda acc, f: acc + _lookup(f, ratios, 0.0))
        return F.struct(F.element_at(names, s["kind"] + 1).alias("kind"), s["first"].alias("first"), s["last"].alias("last"), s["base"].alias("base"), (1 / (1 + F.exp(-total))).alias("score"))

    return cands.select("doc_id", F.filter(F.transform("spans", judged), lambda s: s["base"] | (s["score"] >= LEAST)).alias("spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, all spans as text, and n_spans, the number of all."""
    spans = found(sf_table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")
    base = F.filter("spans", lambda s: s["base"])

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == name))).cast("long").alias(f"n_{name}")

    counts = [count(k.name) for k in KINDS if k.base]
    return spans.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
