"""The driver's tables seen as articles: one definition for the queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2024-01-01 00:00 UTC
EPOCH = 1704067200

ARTICLES_SQL = """articles AS (
  SELECT page_id AS "row", url AS link, regexp_replace(url, '[?#].*$', '') AS originallink,
         regexp_extract(html, '<html lang="([a-z]*)"', 1) AS query,
         CASE WHEN regexp_extract(html, '<html lang="([a-z]*)"', 1) = 'en' THEN 'OUR' ELSE 'COMPETITOR' END AS "group",
         regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
         regexp_extract(html, '(?s)<p>(.*?)</p>', 1) AS description,
         make_timestamp((1704067200 + (page_id % 30) * 86400 + (page_id % 24) * 3600) * 1000000) AS pub_datetime
  FROM pages)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as articles: title element, first paragraph, language as query, a date from the id."""
    lang = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("row"), F.col("url").alias("link"), F.regexp_replace("url", "[?#].*$", "").alias("originallink"),
        lang.alias("query"), F.when(lang == "en", "OUR").otherwise("COMPETITOR").alias("group"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", "(?s)<p>(.*?)</p>", 1).alias("description"),
        F.timestamp_seconds(F.lit(EPOCH) + (F.col("page_id") % 30) * 86400 + (F.col("page_id") % 24) * 3600).alias("pub_datetime"),
    )


LABELLED_SQL = """labelled AS (
  SELECT d.doc_id AS "row", 'https://www.' || d.source || '.example.com/' || d.doc_id AS link, d.lang AS query,
         CASE WHEN d.lang = 'en' THEN 'OUR' ELSE 'competitor' END AS "group", d.text, d.source AS outlet,
         CASE l.quality WHEN 1 THEN '관련' WHEN 0 THEN '언급' END AS brand_relevance,
         CASE WHEN l.toxic = 1 AND l.quality = 0 THEN '부정 확정' WHEN l.toxic = 1 THEN '부정 후보' WHEN l.quality = 1 THEN '중립'
              WHEN l.quality = 0 THEN '긍정' END AS sentiment_stage,
         CASE WHEN l.toxic = 1 THEN CASE WHEN l.quality = 0 THEN '상' ELSE '중' END WHEN l.toxic = 0 THEN '' END AS danger_level,
         CASE WHEN l.quality IS NULL THEN NULL WHEN d.doc_id % 3 = 0 THEN '기타' WHEN d.doc_id % 3 = 1 THEN '시설/오픈' ELSE '고객 경험' END AS news_category
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with labels as classified articles."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    q, t = F.col("quality"), F.col("toxic")
    third = F.col("doc_id") % 3
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").alias("row"), F.concat(F.lit("https://www."), "source", F.lit(".example.com/"), "doc_id").alias("link"),
        F.col("lang").alias("query"), F.when(F.col("lang") == "en", "OUR").otherwise("competitor").alias("group"), "text", F.col("source").alias("outlet"),
        F.when(q == 1, "관련").when(q == 0, "언급").alias("brand_relevance"),
        F.when((t == 1) & (q == 0), "부정 확정").when(t == 1, "부정 후보").when(q == 1, "중립").when(q == 0, "긍정").alias("sentiment_stage"),
        F.when(t == 1, F.when(q == 0, "상").otherwise("중")).when(t == 0, "").alias("danger_level"),
        F.when(q.isNull(), None).when(third == 0, "기타").when(third == 1, "시설/오픈").otherwise("고객 경험").alias("news_category"),
    )
