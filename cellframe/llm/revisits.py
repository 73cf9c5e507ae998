"""Web captures: resolution of not-modified revisits.

An as-of join: each revisit gets the latest earlier full response of its canonical URL. Captures are cut into spans of
time; the last response of each span is carried over the following spans of its URL, and within a span a running last
finds it. So a URL with a third of all captures spreads over its spans. Then validators decide whether the response
still stands, and permitted headers of the revisit replace those of the response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.llm.base import sf_table

#: Headers that a not-modified answer may renew (fixed values, of the HTTP standard).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Time units of a span.
SPAN = 4096


def canonical_url(url: Column) -> Column:
    """Host in lower case without www., user and default port; path without a last slash; sorted parameters.

    Scheme, fragment and utm_ parameters go. Null stays null.
    """
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def resolved(captures: DataFrame, span: int = SPAN) -> DataFrame:
    """captures with url_key, base_id, base_time, status and merged (headers).

    captures: id and time (long), url, revisit (boolean), etag, last_modified and digest (string), headers
    (map<string,string>, names in lower case). Earlier means by time, then id. status is `response` for full responses;
    for revisits `no_base` without an earlier response, `resolved` or `mismatch` by the first of etag (weakly compared),
    last_modified and digest that both have, `unverified` if there is none. Only `resolved` revisits get merged headers:
    the response's, with the revisit's permitted ones put in place; other rows keep their own.
    Null urls never match; a null time counts as before all others, a null revisit as a response, null headers as none.
    Rows that repeat are captures each. Columns of the same names as the new ones are replaced, others carried.
    """
    captures = captures.drop("url_key", "base_id", "base_time", "status", "merged")
    time, is_revisit = F.coalesce(F.col("time"), F.lit(-(1 << 62))), F.coalesce(F.col("revisit"), F.lit(False))
    rows = captures.withColumns({"url_key": canonical_url(F.col("url")), "__time": time, "__span": F.floor(time / span).cast("long"), "__revisit": is_revisit})
    base = F.struct(F.col("__time").alias("time"), "id", "etag", "last_modified", "digest")
    known = F.col("url_key").isNotNull()
    last = rows.where(known & ~F.col("__revisit")).groupBy("url_key", "__span").agg(F.max(base).alias("__last"))
    spans = rows.where(known).select("url_key", "__span").distinct().join(last, ["url_key", "__span"], "left")
    before = Window.partitionBy("url_key").orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("url_key", "__span", F.last("__last", True).over(before).alias("__carried"))
    within = Window.partitionBy("url_key", "__span").orderBy("__time", "id").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.where(known).withColumn("__own", F.last(F.when(~F.col("__revisit"), base), True).over(within)).join(carried, ["url_key", "__span"], "left")
    found = found.withColumn("__base", F.when(F.col("__revisit"), F.coalesce("__own", "__carried"))).drop("__own", "__carried")
    found = found.unionByName(rows.where(~known).withColumn("__base", F.lit(None).cast(found.schema["__base"].dataType)))

    # The response's headers, for the revisits alone, by its id and time.
    headers = rows.where(known & ~F.col("__revisit")).groupBy(F.col("url_key").alias("__k"), F.col("id").alias("__i"), F.col("__time").alias("__t")).agg(F.max(F.to_json("headers")).alias("__theirs"))
    asks = found.where(F.col("__base").isNotNull()).join(headers, (F.col("url_key") == F.col("__k")) & F.col("__base.id").eqNullSafe(F.col("__i")) & (F.col("__base.time") == F.col("__t")), "left").drop("__k", "__i", "__t")
    out = asks.unionByName(found.where(F.col("__base").isNull()).withColumn("__theirs", F.lit(None).cast("string")))

    bare = lambda c: F.regexp_replace(c, "^W/", "")
    verdict = F.coalesce(bare(F.col("__base.etag")) == bare(F.col("etag")), F.col("__base.last_modified") == F.col("last_modified"), F.col("__base.digest") == F.col("digest"))
    status = F.when(~F.col("__revisit"), "response").when(F.col("__base").isNull(), "no_base").when(verdict.isNull(), "unverified").when(verdict, "resolved").otherwise("mismatch")
    none = F.expr("cast(map() as map<string,string>)")
    own = F.coalesce(F.col("headers"), none)
    new = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce(F.from_json("__theirs", "map<string,string>"), none), lambda k, v: ~F.map_contains_key(new, k))
    out = out.withColumns({"base_id": F.col("__base.id"), "base_time": F.col("__base.time"), "status": status})
    out = out.withColumn("merged", F.when(F.col("status") == "resolved", F.map_concat(kept, new)).otherwise(own))
    return out.select(*captures.columns, "url_key", "base_id", "base_time", "status", "merged")


def header_lines(headers: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "; ")


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures from a table of pages, which has no protocol fields: page_id is the time, every third page a revisit.

    The validator is the page's digest, so a revisit stands if the page hasn't changed since the response.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    revisit = F.coalesce(F.pmod("page_id", F.lit(3)) == 2, F.lit(False))
    date = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    full = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.octet_length(html).cast("string"), F.lit("date"), date, F.lit("etag"), F.md5(html))
    short = F.create_map(F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=60"), F.lit("date"), date, F.lit("etag"), F.md5(html))
    none = F.lit(None).cast("string")
    return pages.select(F.col("page_id").alias("id"), F.col("page_id").alias("time"), "url", revisit.alias("revisit"), F.md5(html).alias("etag"), none.alias("last_modified"), none.alias("digest"), F.when(revisit, short).otherwise(full).alias("headers"))


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture; revisits with their response and merged headers."""
    out = resolved(captures_of(sf_table(spark, sf_dir, "pages")))
    return out.select(F.col("id").alias("page_id"), "url_key", F.col("revisit"), "base_id", "status", header_lines(F.col("merged")).alias("headers"))


ORACLE = r"""
WITH u AS (
  SELECT page_id, coalesce(html, '') AS html, coalesce(page_id % 3 = 2, false) AS revisit,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages
), p AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS q FROM u
), k AS (SELECT *, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key, md5(html) AS etag FROM p
), b AS (
  SELECT *, CASE WHEN revisit AND url_key IS NOT NULL THEN last_value(CASE WHEN NOT revisit THEN page_id END IGNORE NULLS) OVER (
    PARTITION BY url_key ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS base_id FROM k
), s AS (
  SELECT b.*, x.html AS base_html, CASE WHEN NOT b.revisit THEN 'response' WHEN b.base_id IS NULL THEN 'no_base' WHEN x.etag = b.etag THEN 'resolved' ELSE 'mismatch' END AS status
  FROM b LEFT JOIN k x ON x.page_id = b.base_id
)
SELECT page_id, url_key, revisit, base_id, status,
  CASE status WHEN 'response' THEN 'content-length: ' || strlen(html) || '; content-type: text/html; date: ' || page_id || '; etag: ' || etag
    WHEN 'resolved' THEN 'cache-control: max-age=60; content-length: ' || strlen(base_html) || '; content-type: text/html; date: ' || page_id || '; etag: ' || etag
    ELSE 'cache-control: max-age=60; content-length: 0; date: ' || page_id || '; etag: ' || etag END AS headers
FROM s
"""
