"""License scans: ordered signature rules over normalised words.

A text that shows no mark of any rule stops at one gate. In the others, a rule's regex runs only where its own
keyword stands. Overlapping detections are resolved in one sweep: what lies within a kept detection goes, and of two that
cut into each other the one of the earlier rule stays.

Rules are written as a table of licenses and a few ways to name a license; their products are the signatures.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import ascii_lower, let, placed, sf_table

#: Between words: everything of ASCII but digits and letters. Applied to text whose A-Z are in lower case.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for text in either case.
GAPS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What a text must hold for any rule or base phrase to match: each pattern has one of these (see test_every_rule_fires).
MARKS = ("licen[sc]", "released under", "spdx", "creativecommons", "creative commons", "public domain", "rights reserved", "cc0", "cc by")
GATE = "(?i)" + "|".join(m.replace(" ", GAPS_ANY_CASE) for m in MARKS)

#: Base phrases and their labels (fixed values).
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: label, keyword, name as a regex over words, short name; versions follow as digits parted by spaces (fixed values).
LICENSES = (
    ("agpl", "affero", r"(?:gnu )?affero general public", "agpl", ("3 0", "3", "1 0")),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public", "lgpl", ("3 0", "3", "2 1", "2 0")),
    ("lgpl-library", "library", r"(?:gnu )?library general public", "lgpl", ("2 0", "2")),
    ("gfdl", "documentation", r"(?:gnu )?free documentation", "gfdl", ("1 3", "1 2", "1 1")),
    ("gpl", "general public", r"(?:gnu )?general public", "gpl", ("3 0", "3", "2 0", "2", "1 0")),
    ("apache", "apache", r"apache(?: software)?", "apache", ("2 0", "2", "1 1", "1 0")),
    ("mit", "mit", r"mit", "mit", ()),
    ("mit-0", "attribution", r"mit no attribution", "mit 0", ()),
    ("bsd-4-clause", "clause", r"(?:bsd 4|4) clause(?: bsd)?", "bsd 4 clause", ()),
    ("bsd-3-clause", "clause", r"(?:bsd 3|3) clause(?: bsd)?", "bsd 3 clause", ()),
    ("bsd-2-clause", "clause", r"(?:bsd 2|2) clause(?: bsd)?", "bsd 2 clause", ()),
    ("bsd", "bsd", r"(?:new |modified |simplified )?bsd", "bsd", ()),
    ("mpl", "mozilla", r"mozilla public", "mpl", ("2 0", "1 1", "1 0")),
    ("epl", "eclipse", r"eclipse public", "epl", ("2 0", "1 0")),
    ("eupl", "european", r"european union public", "eupl", ("1 2", "1 1")),
    ("cddl", "distribution", r"common development and distribution", "cddl", ("1 1", "1 0")),
    ("cpl", "common public", r"common public", "cpl", ("1 0",)),
    ("artistic", "artistic", r"artistic", "artistic", ("2 0", "1 0")),
    ("zlib", "zlib", r"zlib(?: libpng)?", "zlib", ()),
    ("isc", "isc", r"isc", "isc", ()),
    ("boost", "boost", r"boost software", "bsl", ("1 0",)),
    ("unlicense", "unlicense", r"unlicense", "unlicense", ()),
    ("wtfpl", "want to public", r"do what the \w+ you want to public", "wtfpl", ("2",)),
    ("python", "python", r"python software foundation", "psf", ("2 0", "2")),
    ("postgresql", "postgresql", r"postgresql", "postgresql", ()),
    ("ofl", "open font", r"(?:sil )?open font", "ofl", ("1 1", "1 0")),
    ("odbl", "open database", r"open database", "odbl", ("1 0",)),
    ("vim", "vim", r"vim", "vim", ()),
    ("php", "php", r"php", "php", ("3 01", "3 0")),
    ("ruby", "ruby", r"ruby", "ruby", ()),
    ("openssl", "openssl", r"openssl", "openssl", ()),
    ("w3c", "w3c", r"w3c software", "w3c", ()),
    ("ms-pl", "microsoft public", r"microsoft public", "ms pl", ()),
    ("sleepycat", "sleepycat", r"sleepycat", "sleepycat", ()),
)
#: Creative Commons: parts of a license, their words and their tag (fixed values).
COMMONS = (("by-nc-nd", "attribution noncommercial noderiv(?:ative)?s", "by nc nd"), ("by-nc-sa", "attribution noncommercial sharealike", "by nc sa"), ("by-nd", "attribution noderiv(?:ative)?s", "by nd"), ("by-sa", "attribution sharealike", "by sa"), ("by-nc", "attribution noncommercial", "by nc"), ("by", "attribution", "by"))
COMMONS_VERSIONS = ("4 0", "3 0", "2 5", "2 0", "1 0")


class Rule(NamedTuple):
    """Earlier rules win. The pattern is matched over words that stand between single spaces."""

    label: str
    keyword: str
    pattern: str
    score: float


def rules() -> list[Rule]:
    """All signatures, the most telling first."""
    out = []
    tag = lambda label, v: f"{label}-{v.replace(' ', '.')}" if v else label
    full, named, short = [], [], []
    for label, keyword, name, brief, versions in LICENSES:
        for v in (*versions, ""):
            end = f" {v}" if v else ""
            out.append(Rule(tag(label, v), "spdx", f" spdx license identifier {brief}{end}(?: or later| only)?(?= )", 1.0))
            if v:
                full.append(Rule(tag(label, v), keyword, f" {name} licen[sc]e (?:version |v ?)?{v}(?= )", 0.95))
                number = f"{brief} ?(?:version ?|v ?)?{v}"  # "gpl v3" and "gplv3" alike
                short += [Rule(tag(label, v), brief.split()[0], f" {number}(?: or later| only)? licen[sc]ed?(?= )", 0.8), Rule(tag(label, v), brief.split()[0], f" (?:licensed|released) under (?:the )?{number}(?= )", 0.8)]
            else:
                named += [Rule(label, keyword, f" (?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?{name} licen[sc]e(?= )", 0.9), Rule(label, keyword, f" {name} licen[sc]e(?= )", 0.85)]
                short.append(Rule(label, brief.split()[0], f" (?:licensed|released) under (?:the )?{brief}(?= )", 0.75))
    for parts, name, brief in COMMONS:
        for v in (*COMMONS_VERSIONS, ""):
            label, end = tag(f"cc-{parts}", v), f" {v}" if v else ""
            out.append(Rule(label, "creativecommons", f" creativecommons org licenses {brief}{end}(?= )", 1.0))
            full.append(Rule(label, "creative commons", f" creative commons {name}{end}(?: international| unported| generic)?(?: public)?(?: licen[sc]e)?(?= )", 0.95))
            full.append(Rule(label, "cc", f" (?:licensed under )?cc {brief}{end}(?= )", 0.9 if v else 0.8))
    out += full + named + short
    out.append(Rule("cc0", "cc0", " cc0(?: 1 0)?(?: universal)?(?= )", 0.9))
    out.append(Rule("public-domain", "public domain", " (?:dedicated to|released into|in) the public domain(?= )", 0.7))
    out.append(Rule("all-rights-reserved", "rights reserved", " all rights reserved(?= )", 0.6))
    out.append(Rule("unknown-license", "licen", " licensed under(?: the)?(?= )", 0.3))
    return out


def _places(ws: Column, phrase: str) -> Column:
    """Where the words of phrase stand consecutively in ws."""
    ids = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1)).otherwise(F.array().cast("array<int>"))
    parts = phrase.split()

    def stands(i: Column) -> Column:
        test = F.get(ws, i) == parts[0]
        for k, w in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(ws, i + k) == w, F.lit(False))
        return test

    return F.filter(ids, stands)


_SPAN = "struct<first:int,last:int,rank:int,label:string,score:double>"


def _detections(line: Column, known: list[Rule]) -> Column:
    """Spans (characters of line) of all rules whose keyword line has, by start."""
    table = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(r.label).alias("label"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"), F.lit(r.score).alias("score")) for i, r in enumerate(known)])

    def spans(r: Column) -> Column:
        found, between = F.regexp_extract_all(line, r["pattern"], F.lit(0)), F.split(line, r["pattern"], -1)

        def one(i: Column, first: Column, last: Column) -> Column:
            return F.array(F.struct(first.alias("first"), last.alias("last"), r["rank"].alias("rank"), r["label"].alias("label"), r["score"].alias("score")))

        return let(found, lambda f: let(between, lambda g: placed(f, g, one, _SPAN)))

    return F.array_sort(F.flatten(F.transform(F.filter(table, lambda r: F.contains(line, r["keyword"])), spans)), _in_sweep)


def _in_sweep(a: Column, b: Column) -> Column:
    """By start, then the longer, then the earlier rule."""
    sign = lambda x: F.signum(x).cast("int")
    return F.when(a["first"] != b["first"], sign(a["first"] - b["first"])).when(a["last"] != b["last"], sign(b["last"] - a["last"])).otherwise(sign(a["rank"] - b["rank"]))


def _resolved(spans: Column) -> Column:
    """Spans without those within a kept one; of two that overlap, the earlier rule's."""
    none = F.array().cast(f"array<{_SPAN}>")

    def step(kept: Column, x: Column) -> Column:
        top = F.get(kept, F.size(kept) - 1)
        apart = (F.size(kept) == 0) | (x["first"] >= top["last"])
        better = (x["last"] > top["last"]) & (x["rank"] < top["rank"])
        return F.when(apart, F.concat(kept, F.array(x))).when(better, F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(x))).otherwise(kept)

    return F.aggregate(spans, none, step)


def scanned(docs: DataFrame, known: list[Rule] | None = None) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score and detections.

    detections: label, first and last (characters in the normalised words), score; score: the best of them, 1 for any
    base phrase, 0 for none. Null and empty texts have no words and no labels; the places are then null. Whole texts
    are scanned. Rows are independent: repeated rows get equal results. Clashing columns are replaced.
    """
    known = rules() if known is None else known
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    docs = docs.drop(*new)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n_words = F.size(F.array_remove(F.split(text, GAPS_ANY_CASE), "")).cast("long")

    def read(ws: Column) -> Column:
        base = F.array(*[F.struct(F.lit(label).alias("label"), _places(ws, phrase).alias("at")) for phrase, label in BASE])
        found = let(F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" ")), lambda line: _resolved(_detections(line, known)))
        return F.struct(base.alias("base"), found.alias("found"))

    scan = F.when(text.rlike(GATE), let(F.array_remove(F.split(ascii_lower(text), GAPS), ""), read))
    rows = docs.withColumn("__scan", scan).withColumn("n_words", n_words)
    places = F.flatten(F.col("__scan.base.at"))
    hit = F.transform(F.filter("__scan.base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    rows = rows.withColumns({"__places": places, "__hit": F.coalesce(hit, F.array().cast("array<string>")), "__found": F.coalesce(F.col("__scan.found"), F.array().cast(f"array<{_SPAN}>"))})
    labels = F.array_sort(F.array_distinct(F.concat("__hit", F.transform("__found", lambda x: x["label"]))))
    best = F.coalesce(F.array_max(F.transform("__found", lambda x: x["score"])), F.lit(0.0))
    return rows.withColumns({
        "n_base": F.greatest(F.coalesce(F.size("__places"), F.lit(0)), F.lit(0)).cast("long"), "first_word": F.array_min("__places").cast("long"), "last_word": F.array_max("__places").cast("long"),
        "base_labels": F.array_join(F.array_sort(F.array_distinct("__hit")), ","), "labels": F.array_join(labels, ","),
        "score": F.when(F.size("__hit") > 0, 1.0).otherwise(best), "detections": F.transform("__found", lambda x: F.struct(x["label"].alias("label"), x["first"].alias("first"), x["last"].alias("last"), x["score"].alias("score"))),
    }).select(*docs.columns, *new)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(sf_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")
