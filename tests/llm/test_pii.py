import hashlib
import re

from cellframe.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text) if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return sorted(out)


def agree(rows, texts):
    seen = 0
    for r in rows:
        want = base(texts[r["doc_id"]] or "")
        line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(x[3] == k for x in want) for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
        assert r["n_spans"] == len(list(filter(None, r["spans"].split(","))))
        seen += len(want)
    return seen


def test_documents(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pii.op1_pii(spark, sf).collect()
    assert len(rows) == len(texts) and agree(rows, texts) > 20
    # Planted keys are found by the trained classifier.
    planted = re.compile(r'AKIA[0-9A-Z]{16}|password=[0-9a-f]{8,}|token = "[0-9a-f]{20,}"')
    keys = {d for d, t in texts.items() if t and planted.search(t)}
    assert keys and keys <= {r["doc_id"] for r in rows if "secret:" in r["spans"]}


def test_odd_texts(spark, tmp_path):
    texts = {
        1: "a@b.c.@y.z .x@y.z a@b..c é@x.org ünï a.b%c+d@e-f.g-h.i.", 2: "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 1.2.3 " + "9" * 50 + ".1.1.1",
        3: "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1 2 3", 4: "+1 (988) 555-2485. +49 30 123456) +1 ( +12345678 +1234567890123456", 5: None, 6: "",
        7: "7 " * 30_000, 8: "@" * 5000 + "a" * 200_000, 9: "😀 a@b.c 😀 1.1.1.1 😀+1 2345 67890", 10: "1.1.1.1@a.b +1.2.3.4567890",
    }
    spark.createDataFrame([*texts.items(), (9, texts[9])], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = pii.op1_pii(spark, str(tmp_path)).collect()
    assert len(rows) == 11
    assert agree(rows, texts)


def test_estimation_ranks_votes():
    p = pii.estimated({(0, "1111"): 50, (0, "0000"): 50, (0, "11-1"): 30, (0, "00-1"): 30})
    assert p[0, "1111"] > 0.9 > 0.5 > p[0, "0000"] and p[0, "11-1"] > p[0, "00-1"]


def test_edge_tables(odd_docs, no_docs):
    assert pii.found(odd_docs).count() == odd_docs.count()
    assert pii.found(no_docs).count() == 0
