"""Page finding over documents, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studygraph.operators.pages import fill_gaps, page_score, title_filter, top_pages
from studygraph.registry import query, table


@query("page_score_topk", """
WITH d AS (SELECT doc_id, source, lower(coalesce(text, '')) AS t FROM documents), s AS (
  SELECT doc_id, source,
    CAST(2.0 * (CASE WHEN contains(t, 'license') THEN 1 ELSE 0 END + CASE WHEN contains(t, 'released under') THEN 1 ELSE 0 END)
    + 0.5 * (len(regexp_extract_all(t, ' the ')) + len(regexp_extract_all(t, ' der ')) + len(regexp_extract_all(t, ' des ')))
    + CASE WHEN len(regexp_extract_all(t, ' and ')) >= 3 THEN 3.0 ELSE 0.0 END AS DOUBLE) AS score
  FROM d)
SELECT source, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 5
""")
def page_score_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest-scoring documents of each source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", page_score(F.col("text"), ["license", "released under"], [" the ", " der ", " des "], " and ").alias("score"))
    return top_pages(docs, "source", "score", "doc_id", 5).select("source", "doc_id", "score", "rank")


@query("page_title_filter", """
SELECT page_id, url FROM pages
WHERE regexp_matches(html, '<title>[^<]*[Ll]icen[sc]e') OR (regexp_matches(html, '<title>') AND
  (CASE WHEN regexp_matches(html, '<nav') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(html, '<p>') THEN 1 ELSE 0 END
  + CASE WHEN regexp_matches(html, '<li') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(html, '<footer') THEN 1 ELSE 0 END
  + CASE WHEN regexp_matches(html, '<script') THEN 1 ELSE 0 END) >= 3)
""")
def page_title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages with a captioned title, or a title and three structure marks."""
    return table(spark, sf_dir, "pages").filter(title_filter(F.col("html"), "<title>[^<]*[Ll]icen[sc]e", "<title>", ["<nav", "<p>", "<li", "<footer", "<script"])).select("page_id", "url")


@query("page_gap_fill", """
WITH k AS (SELECT DISTINCT user_id, CAST(dayofyear(ts) AS INTEGER) AS day FROM events WHERE event_type = 'purchase'),
g AS (SELECT *, lead(day) OVER w AS nx, lag(day) OVER w AS pv FROM k WINDOW w AS (PARTITION BY user_id ORDER BY day)),
b AS (SELECT user_id, CASE WHEN pv IS NULL THEN greatest(day - 1, 1) ELSE day END AS lo,
  CASE WHEN nx IS NULL THEN least(day + 1, 366) WHEN nx - day <= 3 THEN nx - 1 ELSE day END AS hi FROM g)
SELECT DISTINCT user_id, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS day FROM b
""")
def page_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of a user's purchases, with gaps of up to two days filled."""
    days = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase").select("user_id", F.dayofyear("ts").alias("day"))
    return fill_gaps(days, "user_id", "day", 1, F.lit(366))
