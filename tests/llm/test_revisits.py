from cellframe.llm import revisits
from pyspark.sql import functions as F

SCHEMA = "id long, time long, url string, revisit boolean, etag string, last_modified string, digest string, headers map<string,string>, status string"


def brute(rows):
    out = {}
    for r in rows:
        best = max(((o[1], o[0]) for o in rows if not o[3] and o[2] == r[2] and r[2] is not None and (o[1], o[0]) < (r[1], r[0])), default=None)
        out[r[0]] = best[1] if r[3] and best else None
    return out


def test_as_of_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(i, rng.randrange(300), f"http://h/{rng.randrange(4)}", rng.random() < 0.5, None, None, None, None, "x") for i in range(400)]
    for span in (1, 16, 4096):
        got = {r["id"]: r["base_id"] for r in revisits.resolved(spark.createDataFrame(rows, SCHEMA), span).collect()}
        assert got == brute(rows)


def test_validators_and_headers(spark):
    h = {"content-type": "text/html", "etag": "1", "date": "d1", "server": "s"}
    rows = [
        (1, 1, "http://WWW.a.org:80/x/?b=2&a=1&utm_source=q#f", False, "1", "m", None, h, "old"), (2, 2, "https://a.org/x?a=1&b=2", True, "W/1", None, None, {"date": "d2", "server": "t", "content-type": "no"}, "old"),
        (3, 3, "http://a.org/x?a=1&b=2", True, "2", "m", None, {"date": "d3"}, "old"), (4, 4, "http://a.org/x?a=1&b=2", True, None, "m", None, None, "old"), (5, 5, "http://a.org/x?a=1&b=2", True, None, None, None, None, "old"),
        (6, 0, "http://a.org/x?a=1&b=2", True, "1", None, None, None, "old"), (7, 7, None, True, "1", None, None, None, None), (8, None, "http://a.org/y", None, None, None, None, None, None), (9, 9, "a.org/y", True, None, None, None, None, None),
    ]
    got = {r["id"]: r for r in revisits.resolved(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i]["status"] for i in range(1, 10)] == ["response", "resolved", "mismatch", "resolved", "unverified", "no_base", "no_base", "response", "unverified"]
    assert got[2]["merged"] == {"content-type": "text/html", "etag": "1", "date": "d2", "server": "s"} and got[3]["merged"] == {"date": "d3"} and got[4]["merged"] == h
    assert got[1]["url_key"] == "a.org/x?a=1&b=2"
    assert revisits.resolved(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = spark.createDataFrame(rows + rows, SCHEMA)
    assert revisits.resolved(twice).where(F.col("id") == 2).count() == 2
