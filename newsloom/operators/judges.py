"""A model's answers for groups: verdicts on clusters one by one, summaries and outlets in batches of fixed size.

Groups are aggregated and numbered by Spark, prompts are filled in by expressions, and answers are read, exploded and
joined back to the groups that were asked about; only the calls run in Python (``sources.model``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MEDIA_TYPES, OTHER_CATEGORY, PRESS_RELEASE, SIMILAR_TOPIC
from ..functions.json import repair, response_text, summaries
from ..functions.text import non_blank
from ..sources.model import Post, answers, call_model, render_column
from ..storage import materialise
from .keyed import row_numbers

#: Titles of a cluster that a prompt shows; characters of a description; clusters and domains in a batch.
TITLES = 10
DESCRIPTION = 200
CLUSTERS = 20
DOMAINS = 100

#: Clusters (cluster_id, query, cluster_summary, article_count, titles_list, labels) -> (cluster_id, source_type), one call each.
ClusterJudge = Callable[[DataFrame], DataFrame]


def batches(groups: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """(batch, items): at most ``size`` groups each, in ``order``, which should be unique; numbered without a global window."""
    numbered = row_numbers(groups, order, "_n")
    item = F.struct("_n", *groups.columns)
    return numbered.groupBy(F.floor((F.col("_n") - 1) / size).alias("batch")).agg(F.array_sort(F.collect_list(item)).alias("items"))


def cluster_prompts(press: DataFrame, order: str = "row") -> DataFrame:
    """What a prompt says of each cluster: the first row's query and summary, the number of articles, the first TITLES titles
    and how many more there are, and the labels of the first classified row, or of the first one."""
    ranked = press.withColumn("_rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy(order))).where(F.col("_rank") <= TITLES)
    titles = ranked.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("_rank", F.coalesce("title", F.lit("")).alias("title")))).alias("titles"))
    labels = F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in ("brand_relevance", "sentiment_stage", "news_category")])
    classified = non_blank(F.col("brand_relevance")).isNotNull()
    whole = press.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("article_count"), F.min_by("query", order).alias("query"), F.min_by(F.coalesce("cluster_summary", F.lit("")), order).alias("cluster_summary"),
        F.min_by(labels, F.struct(~classified, F.col(order))).alias("labels"),
    )
    lines = F.array_join(F.transform("titles", lambda t: F.concat(F.lit("- "), t["title"])), "\n")
    more = F.col("article_count") - TITLES
    listed = F.when(more > 0, F.concat(lines, F.lit("\n- ... and "), more.cast("string"), F.lit(" more"))).otherwise(lines)
    return whole.join(titles, "cluster_id").select("cluster_id", "query", "cluster_summary", "article_count", listed.alias("titles_list"), "labels.*")


def cluster_judge(post: Post, template: str, **calling) -> ClusterJudge:
    """The judge that asks a model about each cluster; a failed call or another word than the two sources is no verdict."""

    def judge(clusters: DataFrame) -> DataFrame:
        prompt = render_column(template, {c: F.col(c) for c in clusters.columns})
        read = answers(call_model(clusters.select("cluster_id", prompt.alias("_prompt")), "_prompt", post, **calling), "source_type string")
        verdict = F.col("answer.source_type")
        return materialise(read.select("cluster_id", F.when(verdict.isin(PRESS_RELEASE, SIMILAR_TOPIC), verdict).alias("source_type")), "verdicts")

    return judge


def _asked(groups: DataFrame, order: Sequence[Column], line: Column, template: str, post: Post, size: int, **calling) -> DataFrame:
    """batch, items, payload, status of every batch; written, as a model answers differently each time. ``{{items}}`` are the lines."""
    lined = batches(groups.withColumn("_line", line), order, size)
    prompt = render_column(template, {"items": F.array_join(F.transform("items", lambda x: x["_line"]), "\n")})
    return materialise(call_model(lined.select("batch", "items", prompt.alias("_prompt")), "_prompt", post, **calling), "batch_answers")


def summaries_by_model(post: Post, template: str, size: int = CLUSTERS, **calling) -> Callable[[DataFrame], DataFrame]:
    """(cluster_id, title, description) -> (cluster_id, cluster_summary), ``size`` clusters a call.

    Where a batch has no answer, or none that can be read, its clusters are named by their titles' first 15 characters. A
    cluster that an answer leaves out gets none; of two answers for one cluster the last counts; answers for clusters
    that weren't asked about are passed over.
    """

    def summarise(groups: DataFrame) -> DataFrame:
        text = lambda c: F.coalesce(F.col(c), F.lit(""))
        line = F.concat(F.lit("["), F.col("cluster_id"), F.lit("]\ntitle: "), text("title"), F.lit("\ndescription: "), F.substring(text("description"), 1, DESCRIPTION))
        asked = _asked(groups, [F.col("cluster_id")], line, template, post, size, **calling)
        found = asked.withColumn("answers", F.when(F.col("status") == "ok", summaries(response_text(F.col("payload")))))
        given = found.where(F.col("answers").isNotNull())
        mine = given.select("items", F.posexplode("answers").alias("at", "x")).where(F.exists("items", lambda i: i["cluster_id"] == F.col("x.cluster_id")))
        mine = mine.where(F.col("x.summary").isNotNull()).groupBy(F.col("x.cluster_id").alias("cluster_id")).agg(F.max_by("x.summary", "at").alias("cluster_summary"))
        rest = found.where(F.col("answers").isNull()).select(F.explode("items").alias("i"))
        return mine.unionByName(rest.select(F.col("i.cluster_id").alias("cluster_id"), F.substring(F.coalesce("i.title", F.lit("")), 1, 15).alias("cluster_summary")))

    return summarise


def outlets_by_model(post: Post, template: str, size: int = DOMAINS, **calling) -> Callable[[DataFrame], DataFrame]:
    """(domain) -> (domain, media_name, media_group, media_type), ``size`` domains a call.

    The answer maps domains to names, groups and types. A domain without one is named after itself, a blank group is the
    name, and an unknown type counts as the one for everything else.
    """
    kind = "map<string, struct<media_name:string, media_group:string, media_type:string>>"

    def resolve(domains: DataFrame) -> DataFrame:
        asked = _asked(domains.select("domain"), [F.col("domain")], F.concat(F.lit("- "), F.col("domain")), template, post, size, **calling)
        read = F.from_json(repair(response_text(F.col("payload"))), kind, {"mode": "PERMISSIVE"})
        each = asked.withColumn("given", F.when(F.col("status") == "ok", read)).select("given", F.explode("items").alias("i"))
        x = F.try_element_at("given", F.col("i.domain"))
        name = F.coalesce(non_blank(x["media_name"]), F.col("i.domain"))
        type_ = F.when(x["media_type"].isin(*MEDIA_TYPES), x["media_type"]).otherwise(OTHER_CATEGORY)
        return each.select(F.col("i.domain").alias("domain"), name.alias("media_name"), F.coalesce(non_blank(x["media_group"]), name).alias("media_group"), type_.alias("media_type"))

    return resolve
