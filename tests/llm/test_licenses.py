import itertools
import re

from cellframe.llm import licenses


def brute(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    at, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def agree(rows, texts):
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_documents(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = licenses.op5_licenses(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r["n_base"] for r in rows) > 5
    agree(rows, texts)


def test_odd_texts(spark):
    texts = ["MIT-License mit license CC-BY cc.by by cc by", "GNU General\nPublic   License, version 3.", "ccé by", "licence", None, "", "İ mit licensé mit license", "apache licenses Apache_License", "cc\x00by " * 500, "Public Domain", "ſ mit K license"]
    rows = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    agree(rows, texts)


def test_rules_resolve(spark):
    texts = ["under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "GNU Affero General Public License v3.0", "SPDX-License-Identifier: Apache-2.0", "Released under the MIT License.", "nothing of the kind, licensed under it"]
    rows = {r["doc_id"]: r for r in licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0]["labels"] == "gpl,gpl-3" and rows[1]["labels"] == "cc-by,cc-by-nc-4.0"
    assert rows[2]["labels"] == "agpl-3.0" and rows[3]["labels"] == "apache-2.0" and rows[4]["labels"] == "mit"
    assert rows[5]["labels"] == "unknown-license" and rows[5]["score"] == 0.3
    assert len(licenses.rules()) > 200


def test_short_names_with_versions(spark):
    want = {"Licensed under GPLv3": "gpl-3", "Released under the LGPL v2.1.": "lgpl-2.1", "the gplv2 license": "gpl-2", "GPL-3.0-or-later licensed": "gpl-3.0", "licensed under apache 2.0": "apache-2.0", "EPLv1.0 License": "epl-1.0"}
    rows = licenses.scanned(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")).collect()
    assert {list(want)[r["doc_id"]]: r["labels"] for r in rows} == want


def phrases(pattern):
    """Texts that a rule's pattern matches, without its optional parts."""
    p = pattern.replace("(?= )", "").replace(r"\w+", "heck")
    while (q := re.sub(r"\(\?:[^()]*\)\?", "", p)) != p:
        p = q
    p = re.sub(r"[\w ]\?", "", p)
    parts = [x.split("|") if i % 2 else [x] for i, x in enumerate(re.split(r"\(\?:([^()]*)\)", p.replace("[sc]", "(?:s|c)")))]
    return ["".join(x).strip() for x in itertools.product(*parts)]


def test_every_rule_fires(spark):
    first = {}
    for r in licenses.rules():
        first.setdefault(r.pattern, r)  # of equal patterns the earlier rule wins
    want = [(text.replace(" ", gap), r) for r in first.values() for text in phrases(r.pattern) for gap in (" ", "  ", ",\n-")]
    got = {r["doc_id"]: r for r in licenses.scanned(spark.createDataFrame([(i, t.title()) for i, (t, _) in enumerate(want)], "doc_id long, text string")).collect()}
    assert [(t, r.label) for i, (t, r) in enumerate(want) if r.label not in got[i]["labels"].split(",") or got[i]["score"] < r.score] == []


def test_edge_tables(odd_docs, no_docs):
    assert licenses.scanned(odd_docs).count() == odd_docs.count()
    assert licenses.scanned(no_docs).count() == 0
