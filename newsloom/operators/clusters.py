"""Clustering of articles: press releases, cross-block merge, topics; numbering, representatives, propagation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import CrossMerge, PressRelease, Topics
from ..constants import GENERAL, OUR, PRESS_RELEASE, SIMILAR_TOPIC, UNRELATED_CATEGORY
from ..functions.dates import day_gap, fractional_days
from ..functions.scores import blend
from ..functions.text import clean_markup, cluster_label, cluster_number, media_key, non_blank, normalise_group, query_prefix, summary_tokens
from ..storage import exists, materialise
from .cells import pair_scores
from .components import connected_components
from .keyed import left_join_filled, row_numbers
from .similarity import jaccard_pairs


def scored_pairs(rows: DataFrame, title_least: float, desc_least: float, least_df: int, alike: float | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """(block, i, j, t_cos, t_jac, d_cos, d_jac) of pairs with a cosine of that least in either channel, or titles that alike.

    rows: block, row, title, desc; carried columns come as i_name and j_name. The other channel's cosine is 0 where it is
    below its least.
    """
    names = {"cos0": "t_cos", "jac0": "t_jac", "cos1": "d_cos", "jac1": "d_jac"}
    return pair_scores(rows, ["title", "desc"], [title_least, desc_least], least_df, alike, carry).withColumnsRenamed(names)


def saved_pairs(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; what ``build`` gives is written there first, unless a whole one is there already."""
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def press_release_rule(gap: Column, cfg: PressRelease) -> Column:
    """title, desc, strong or border_title, border_desc; null: no relation. A null date makes no edge."""
    near = gap <= cfg.day_window
    t_cos, t_jac, d_cos, d_jac = (F.col(c) for c in ("t_cos", "t_jac", "d_cos", "d_jac"))
    return (
        F.when(near & (t_cos >= cfg.title_cosine) & (t_jac >= cfg.title_jaccard), "title")
        .when(near & (d_cos >= cfg.desc_cosine) & (d_jac >= cfg.desc_jaccard), "desc")
        .when((gap >= cfg.strong_start_day) & (d_cos >= cfg.strong_desc_cosine) & (d_jac >= cfg.strong_desc_jaccard), "strong")
        .when(near & (t_cos >= cfg.border_title_cosine) & (t_cos < cfg.title_cosine) & (t_jac >= cfg.border_title_jaccard), "border_title")
        .when(near & (d_cos >= cfg.border_desc_cosine) & (d_cos < cfg.desc_cosine) & (d_jac >= cfg.border_desc_jaccard), "border_desc")
    )


def comparable(articles: DataFrame, block: str = "query", row: str = "row") -> DataFrame:
    """block, row, title, desc (cleaned), day; without rows that have neither text."""
    out = articles.select(
        F.col(block).alias("block"), F.col(row).alias("row"), clean_markup(F.col("title")).alias("title"),
        clean_markup(F.col("description")).alias("desc"), F.col("pub_datetime").cast("date").alias("day"),
    )
    return out.where((F.col("title") != "") | (F.col("desc") != ""))


def press_release_edges(articles: DataFrame, cfg: PressRelease = PressRelease(), borderline: bool = False, block: str = "query") -> DataFrame:
    """(block, i, j, rule, scores) of related articles; with ``borderline`` also the pairs a judge would see."""
    rows = comparable(articles, block)
    least = (cfg.border_title_cosine, cfg.border_desc_cosine) if borderline else (cfg.title_cosine, cfg.desc_cosine)
    pairs = scored_pairs(rows, *least, 2, carry=["day"])
    ruled = pairs.withColumn("rule", press_release_rule(day_gap(F.col("i_day"), F.col("j_day")), cfg))
    ruled = ruled.where(F.col("rule").isNotNull()).drop("i_day", "j_day")
    return ruled if borderline else ruled.where(~F.col("rule").startswith("border"))


def top_edges(edges: DataFrame, k: int = 3) -> DataFrame:
    """Each node's k best edges by blended score, ties by the other node; (i, j, score), every edge once."""
    score = F.greatest(blend(F.col("t_cos"), F.col("t_jac")), blend(F.col("d_cos"), F.col("d_jac")))
    s = edges.select("i", "j", F.round(score, 9).alias("score"))
    both = s.select(F.col("i").alias("node"), F.col("j").alias("other"), "score").unionByName(s.select(F.col("j").alias("node"), F.col("i").alias("other"), "score"))
    w = Window.partitionBy("node").orderBy(F.desc("score"), "other")
    best = both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select(F.least("node", "other").alias("i"), F.greatest("node", "other").alias("j"), "score").distinct()


def numbered_clusters(members: DataFrame, kind: str = "c", start: int = 0) -> DataFrame:
    """(row, cluster_id) of (row, component, prefix): numbered by prefix (by block, where there is one), then by first member.
"""
    block = ["block"] if "block" in members.columns else []
    clusters = members.groupBy("component", "prefix", *block).agg(F.min("row").alias("first"))
    ids = row_numbers(clusters, [F.col((block or ["prefix"])[0]).asc(), F.col("first").asc()], "_n")
    ids = ids.withColumn("cluster_id", cluster_label(query_prefix(F.col("prefix")), kind, F.col("_n") + start))
    return members.join(ids.select("component", "cluster_id"), "component").select("row", "cluster_id")


#: Representatives (row, query, group, title, description) of borderline components -> row of those that stand.
Judge = Callable[[DataFrame], DataFrame]


def approved_edges(border: DataFrame, articles: DataFrame, judge: Judge, least: int = 2) -> DataFrame:
    """(i, j) that join the components of ``border`` of at least that many rows whose representative the judge approves."""
    parts = connected_components(border, "i", "j").select(F.col("node").alias("row"), "component")
    large = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    parts = materialise(parts.join(large.select("component"), "component"), "borderline")
    reps = materialise(longest_representatives(articles.join(parts, "row"), "component", "pub_datetime", "row"), "judged")
    stands = materialise(judge(reps.select("row", "query", "group", "title", "description")).select("row"), "approved")
    good = reps.join(stands, "row").select("component")
    return parts.join(good, "component").where("row != component").select(F.col("component").alias("i"), F.col("row").alias("j"))


def _border_scores(edges: DataFrame, cfg: PressRelease) -> DataFrame:
    """Borderline edges with the scores of the channels that make them borderline; 0 in the other one."""
    title = (F.col("t_cos") >= cfg.border_title_cosine) & (F.col("t_cos") < cfg.title_cosine) & (F.col("t_jac") >= cfg.border_title_jaccard)
    desc = (F.col("d_cos") >= cfg.border_desc_cosine) & (F.col("d_cos") < cfg.desc_cosine) & (F.col("d_jac") >= cfg.border_desc_jaccard)
    return edges.where(F.col("rule").startswith("border")).withColumns(
        {c: F.when(title if c.startswith("t") else desc, F.col(c)).otherwise(0.0) for c in ("t_cos", "t_jac", "d_cos", "d_jac")}
    )


def detect_press_releases(
    articles: DataFrame, cfg: PressRelease = PressRelease(), start: int = 0, judge: Judge | None = None, group_our_brands: bool = False
) -> DataFrame:
    """The articles with source and cluster_id: components of related articles in a block are press releases.

    judge: what decides on borderline components of three or more (by each article's three best borderline edges);
    without one they are left out. group_our_brands: own-brand articles are one block whatever their query.
    """
    own = F.when(normalise_group(F.col("group")) == OUR, OUR).otherwise(F.col("query")) if group_our_brands else F.col("query")
    blocked = articles.withColumn("_block", own)
    edges = press_release_edges(blocked, cfg, judge is not None, "_block")
    if judge:
        edges = materialise(edges, "ruled")
        more = approved_edges(top_edges(_border_scores(edges, cfg)), articles, judge, 3)
        edges = edges.where(~F.col("rule").startswith("border")).select("i", "j").unionByName(more)
    parts = connected_components(edges, "i", "j").select(F.col("node").alias("row"), "component")
    members = parts.join(blocked.select("row", F.col("query").alias("prefix"), F.col("_block").alias("block")), "row")
    if group_our_brands:
        first = members.groupBy("component").agg(F.min_by("prefix", "row").alias("prefix"))
        members = members.drop("prefix").join(first, "component")
    else:
        members = members.drop("block")
    ids = numbered_clusters(members, "c", start)
    out = articles.drop("source", "cluster_id").join(ids, "row", "left")
    return out.withColumn("source", F.when(F.col("cluster_id").isNull(), GENERAL).otherwise(PRESS_RELEASE)).withColumn(
        "cluster_id", F.coalesce("cluster_id", F.lit(""))
    )


def representatives(df: DataFrame, group: str, ts: str, tie: str) -> DataFrame:
    """The earliest row of each group, nulls last."""
    w = Window.partitionBy(group).orderBy(F.col(ts).asc_nulls_last(), F.col(tie))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_values(df: DataFrame, group: str, ts: str, tie: str, columns: list[str]) -> DataFrame:
    """Each group's first non-null value of every column by time (nulls last), then ``tie``; null if it has none.

    One map-side combined aggregate: no group gathers in a task.
    """
    at = F.struct(F.col(ts).isNull().alias("late"), F.col(ts).alias("ts"), F.col(tie).alias("tie"))
    return df.groupBy(group).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])


def longest_representatives(df: DataFrame, group: str, ts: str, tie: str) -> DataFrame:
    """Dated rows first, then the earliest, then the one with the longest title and description."""
    size = F.char_length(F.coalesce("title", F.lit(""))) + F.char_length(F.coalesce("description", F.lit("")))
    w = Window.partitionBy(group).orderBy(F.col(ts).isNull(), F.col(ts), size.desc(), F.col(tie))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def propagate(df: DataFrame, results: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Each group's result on all its members; rows without a result keep what they have."""
    got = results.select(F.col(group).alias("_g"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = left_join_filled(df, got, group, "_g")
    have = [c for c in columns if c in df.columns]
    out = out.withColumns({c: F.coalesce(f"_new_{c}", c) if c in have else F.col(f"_new_{c}") for c in columns})
    return out.drop("_g", *[f"_new_{c}" for c in columns])


def first_summary(df: DataFrame, group: str, summary: str, order: str) -> DataFrame:
    """Every member of a non-blank group gets the group's first non-blank summary by ``order``."""
    have = df.where(non_blank(F.col(group)).isNotNull() & non_blank(F.col(summary)).isNotNull())
    # written, so that the join of a large group can be split
    first = materialise(have.groupBy(F.col(group).alias("_g")).agg(F.min_by(summary, order).alias("_first")), "first_summaries")
    return left_join_filled(df, first, group, "_g").withColumn(summary, F.coalesce("_first", summary)).drop("_first", "_g")


def merge_candidates(df: DataFrame) -> DataFrame:
    """What a cross-block merge compares: each cluster's earliest row, and general articles of a related category."""
    clustered = df.where(non_blank(F.col("cluster_id")).isNotNull())
    reps = representatives(clustered, "cluster_id", "pub_datetime", "row")
    free = df.where(
        non_blank(F.col("cluster_id")).isNull() & (F.col("source") == GENERAL) & (F.coalesce("news_category", F.lit("")) != UNRELATED_CATEGORY)
    )
    return reps.unionByName(free)


def cross_rule(cfg: CrossMerge) -> Column:
    """auto or border by scores alone, else null; border by cosine also asks for a hint (see cross_edges)."""
    t_cos, t_jac, d_cos, d_jac = (F.col(c) for c in ("t_cos", "t_jac", "d_cos", "d_jac"))
    border = ((t_cos >= cfg.border_title_low) & (t_cos < cfg.border_title_high) & (t_jac >= cfg.border_title_jaccard)) | (
        (d_cos >= cfg.border_desc_low) & (d_cos < cfg.border_desc_high) & (d_jac >= cfg.border_desc_jaccard)
    )
    return (
        F.when(t_jac >= cfg.title_jaccard_standalone, "auto")
        .when((t_cos >= cfg.title_cosine) & (t_jac >= cfg.title_jaccard), "auto")
        .when((d_cos >= cfg.desc_cosine) & (d_jac >= cfg.desc_jaccard), "auto")
        .when(t_jac >= cfg.border_jaccard_standalone, "border")
        .when(border & (((F.col("i_media") == F.col("j_media")) & (F.col("i_media") != "")) | (F.col("gap") <= cfg.border_days)), "border")
    )


def cross_edges(df: DataFrame, cfg: CrossMerge = CrossMerge()) -> DataFrame:
    """(i, j, rule, scores) across blocks: not within a cluster, and not between free articles of one query."""
    cand = merge_candidates(df)
    rows = cand.select(
        F.lit("all").alias("block"), "row", clean_markup(F.col("title")).alias("title"), clean_markup(F.col("description")).alias("desc"),
        F.coalesce("cluster_id", F.lit("")).alias("cluster"), "query", F.col("pub_datetime").alias("ts"), media_key(F.col("media_domain"), F.col("link")).alias("media"),
    )
    pairs = scored_pairs(rows, cfg.border_title_low, cfg.border_desc_low, 1, cfg.border_jaccard_standalone, ["cluster", "query", "ts", "media"])
    apart = (F.col("i_cluster") != F.col("j_cluster")) | (F.col("i_cluster") == "")
    apart = apart & ~((F.col("i_query") == F.col("j_query")) & (F.col("i_cluster") == "") & (F.col("j_cluster") == ""))
    pairs = pairs.where(apart).withColumn("gap", fractional_days(F.col("i_ts"), F.col("j_ts")))
    return pairs.withColumn("rule", cross_rule(cfg)).where(F.col("rule").isNotNull()).select("i", "j", "rule", "t_cos", "t_jac", "d_cos", "d_jac")


def with_approved(edges: DataFrame, sure: str, articles: DataFrame, judge: Judge | None) -> DataFrame:
    """(i, j) of the edges whose rule is ``sure``, and of the borderline components that the judge approves."""
    if judge is None:
        return edges.where(F.col("rule") == sure)
    edges = materialise(edges, "ruled")
    more = approved_edges(edges.where("rule = 'border'"), articles, judge)
    return edges.where(F.col("rule") == sure).select("i", "j").unionByName(more)


def merge_across(df: DataFrame, cfg: CrossMerge = CrossMerge(), start: int = 0, judge: Judge | None = None) -> DataFrame:
    """Components over automatic edges share the least cluster id (else a new cross_m id) and one source.

    The press-release label wins in a component; the first non-blank summary goes to all its rows. Borderline
    components that ``judge`` approves are merged too; without one they are left out.
    """
    edges = with_approved(cross_edges(df, cfg), "auto", df, judge)
    parts = materialise(connected_components(edges, "i", "j").select(F.col("node").alias("row"), "component"), "merged")
    cand = parts.join(df.select("row", non_blank(F.col("cluster_id")).alias("old"), "source"), "row")
    groups = cand.groupBy("component").agg(
        F.min("old").alias("least"), F.bool_or(F.col("source") == PRESS_RELEASE).alias("press"), F.min("row").alias("first")
    )
    groups = materialise(groups, "groups")
    fresh = row_numbers(groups.where(F.col("least").isNull()), [F.col("first").asc()], "_n")
    fresh = fresh.withColumn("least", F.concat(F.lit("cross_m"), F.lpad((F.col("_n") + start).cast("string"), 5, "0"))).drop("_n")
    named = groups.where(F.col("least").isNotNull()).unionByName(fresh)
    groups = named.select("component", F.col("least").alias("target"), F.when(F.col("press"), PRESS_RELEASE).otherwise(SIMILAR_TOPIC).alias("label"))
    by_row = parts.join(groups, "component").select(F.col("row").alias("_row"), "target", "label")
    by_cluster = cand.where(F.col("old").isNotNull()).join(groups, "component").select(F.col("old").alias("_old"), F.col("target").alias("_target"), F.col("label").alias("_label")).distinct()
    by_row, by_cluster = materialise(by_row, "by_row"), materialise(by_cluster, "by_cluster")
    out = left_join_filled(df.join(by_row, df["row"] == by_row["_row"], "left"), by_cluster, "cluster_id", "_old")
    out = out.withColumns(
        {
            "cluster_id": F.coalesce("target", "_target", "cluster_id"),
            "source": F.coalesce("label", "_label", "source"),
        }
    ).drop("_row", "target", "label", "_old", "_target", "_label")
    return first_summary(out, "cluster_id", "cluster_summary", "row")


def topic_pairs(df: DataFrame, cfg: Topics = Topics()) -> DataFrame:
    """(i, j, jaccard, rule edge or border) of general articles of one query and category by their summary words."""
    rows = df.where((F.col("source") == GENERAL) & (F.coalesce("news_category", F.lit("")) != UNRELATED_CATEGORY) & (non_blank(F.col("news_category")).isNotNull()))
    rows = rows.select(
        F.to_json(F.struct("query", "news_category")).alias("block"), "row", summary_tokens(F.col("news_keyword_summary")).alias("t")
    )
    pairs = jaccard_pairs(materialise(rows, "topics"), "block", "row", "t", cfg.jaccard_low)
    return pairs.select("i", "j", "jaccard", F.when(F.col("jaccard") >= cfg.jaccard_high, "edge").otherwise("border").alias("rule"))


def group_topics(df: DataFrame, cfg: Topics = Topics(), judge: Judge | None = None) -> DataFrame:
    """Components of sure pairs become similar topics, numbered on from each query prefix's largest _t number.

    Borderline components that ``judge`` approves count as sure; without one they are left out.
    """
    edges = with_approved(topic_pairs(df, cfg), "edge", df, judge)
    parts = connected_components(edges, "i", "j").select(F.col("node").alias("row"), "component")
    members = parts.join(df.select("row", query_prefix(F.coalesce("query", F.lit(""))).alias("prefix")), "row")
    clusters = members.groupBy("component", "prefix").agg(F.min("row").alias("first"))
    old = df.select(F.regexp_extract("cluster_id", r"^(.*)_t[0-9]+$", 1).alias("prefix"), cluster_number(F.col("cluster_id"), "t").alias("n"))
    old = old.where("n is not null").groupBy("prefix").agg(F.max("n").alias("top"))
    w = Window.partitionBy("prefix").orderBy("first")
    ids = clusters.join(old, "prefix", "left").withColumn("n", F.row_number().over(w) + F.coalesce("top", F.lit(0)))
    ids = ids.select("component", cluster_label(F.col("prefix"), "t", F.col("n")).alias("_id"))
    named = members.join(ids, "component").select(F.col("row").alias("_row"), "_id")
    out = df.join(named, df["row"] == named["_row"], "left")
    return out.withColumns(
        {"source": F.when(F.col("_id").isNotNull(), SIMILAR_TOPIC).otherwise(F.col("source")), "cluster_id": F.coalesce("_id", "cluster_id")}
    ).drop("_row", "_id")


def consistent(df: DataFrame) -> DataFrame:
    """General articles carry no cluster."""
    general = F.col("source") == GENERAL
    return df.withColumns({c: F.when(general, "").otherwise(F.col(c)) for c in ("cluster_id", "cluster_summary") if c in df.columns})
