"""Classification: pluggable two-pass classifiers, gates, post-processing, rules, propagation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import (
    BRAND_RELEVANCE, DANGER_LEVELS, FIRST_REASONS, ISSUE_CATEGORIES, NEGATIVE_STAGES, NEWS_CATEGORIES, OTHER_CATEGORY, PR_CATEGORIES, PRESS_RELEASE,
    SECOND_REASONS, SENTIMENT_STAGES, SIMILAR_TOPIC, UNRELATED_CATEGORY,
)
from ..functions.text import clean_invisible, non_blank
from ..sources.model import Post, answers, call_model, render_column
from ..storage import exists, materialise, temporary
from .chunks import run_in_chunks
from .clusters import Judge, first_summary, first_values, group_topics, merge_across, propagate, representatives
from .judges import ClusterJudge, cluster_prompts
from .keyed import row_numbers

#: A written-out reason for each field of an answer; they belong to the article that was asked about, not to its cluster.
_reasons = lambda names: "reasoning struct<" + ",".join(f"{n}:string" for n in names) + ">"
LABELS = "brand_relevance string, brand_relevance_query_keywords array<string>, sentiment_stage string, news_category string, news_keyword_summary string"
DANGER = "danger_level string, issue_category string"
FIRST_PASS = ["brand_relevance", "brand_relevance_query_keywords", "sentiment_stage", "news_category", "news_keyword_summary"]


class Classifier(Protocol):
    """Adds first-pass or second-pass label columns to a table of articles (row, query, group, title, description)."""

    def first_pass(self, articles: DataFrame) -> DataFrame: ...

    def second_pass(self, articles: DataFrame) -> DataFrame: ...


class RuleClassifier:
    """The offline default: deterministic labels from words, in the JVM. Word lists are our own and can be replaced."""

    negative = ("stupid", "worthless", "trash", "disgusting", "scum", "사고", "논란", "불만", "위반", "소송")
    severe = ("disgusting", "scum", "사망", "화재", "구속")
    positive = ("award", "best", "수상", "선정", "호평")

    def _any(self, text: Column, words: tuple[str, ...]) -> Column:
        return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(text, w))

    def first_pass(self, articles: DataFrame) -> DataFrame:
        text = F.lower(F.concat_ws(" ", "title", "description"))
        named = F.exists(F.split(F.coalesce("query", F.lit("")), r"\|"), lambda q: (q != "") & F.contains(text, F.lower(q)))
        relevance = F.when(non_blank(text).isNull(), "판단 필요").when(named, "관련").otherwise("언급")
        sentiment = F.when(self._any(text, self.severe), "부정 확정").when(self._any(text, self.negative), "부정 후보").when(self._any(text, self.positive), "긍정").otherwise("중립")
        category = F.when(self._any(text, self.negative), "리스크/위기").otherwise("PR/보도자료")
        out = articles.withColumns(
            {
                "brand_relevance": relevance,
                "brand_relevance_query_keywords": F.slice(F.filter(F.split(F.coalesce("query", F.lit("")), r"\|"), lambda q: q != ""), 1, 3),
                "sentiment_stage": sentiment,
                "news_category": category,
                "news_keyword_summary": F.array_join(F.slice(F.split(F.trim(F.coalesce("title", F.lit(""))), r"\s+"), 1, 5), " "),
            }
        )
        return post_process(out)

    def second_pass(self, articles: DataFrame) -> DataFrame:
        text = F.lower(F.concat_ws(" ", "title", "description"))
        return articles.withColumns(
            {
                "danger_level": F.when(self._any(text, self.severe), "상").otherwise("중"),
                "issue_category": F.when(self._any(text, ("사고", "화재")), "안전/사고").otherwise("평판/PR"),
            }
        )


class BatchClassifier:
    """An external model behind ``ask`` (list of article dicts -> list of label dicts or None), in Arrow batches.

    ``workers`` bounds how many partitions call at once. A missing answer is a failure: its labels are null and
    ``status`` says so; the row is kept, and the audit finds it again. So is every row of a batch whose ``ask`` raises,
    with the error. An answer's ``reasoning`` (field -> text) goes into a struct of its own.
    """

    def __init__(self, ask_first: Callable[[list[dict]], list[dict | None]], ask_second: Callable[[list[dict]], list[dict | None]], workers: int = 3, batch: int = 20):
        self.ask_first, self.ask_second, self.workers, self.batch = ask_first, ask_second, workers, batch

    def _run(self, articles: DataFrame, ask, schema: str, reasons: list[str]) -> DataFrame:
        import pandas as pd
        from pyspark.sql.types import StructType

        names, size = StructType.fromDDL(schema).names, self.batch
        extra = ["reasoning", "status", "error"]
        columns = [c for c in articles.columns if c not in names and c not in extra]

        def cells(g: dict | None, error: str | None) -> dict:
            why = (g or {}).get("reasoning")
            given = {n: str(why.get(n) or "") for n in reasons} if isinstance(why, dict) else None
            return {n: (g or {}).get(n) for n in names} | {"reasoning": given, "status": "ok" if g else "failed", "error": None if g else error or "no answer"}

        def run(frames):
            for f in frames:
                for at in range(0, max(1, len(f)), size):
                    own, error = f.iloc[at : at + size], None
                    try:
                        got = list(ask(own.to_dict("records"))) if len(own) else []
                    except Exception as problem:  # whatever the model answers: these rows alone fail
                        got, error = [None] * len(own), f"{type(problem).__name__}: {problem}"[:500]
                    more = pd.DataFrame([cells(g, error) for g in got], columns=[*names, *extra], index=own.index)
                    yield pd.concat([own, more], axis=1)

        base = articles.select(*columns)
        out = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in base.schema)
        return base.repartition(self.workers).mapInPandas(run, f"{out}, {schema}, {_reasons(reasons)}, status string, error string")

    def first_pass(self, articles: DataFrame) -> DataFrame:
        return post_process(self._run(articles, self.ask_first, LABELS, FIRST_REASONS))

    def second_pass(self, articles: DataFrame) -> DataFrame:
        return self._run(articles, self.ask_second, DANGER, SECOND_REASONS)


class ModelClassifier:
    """A language model behind ``post``, asked one article a call with prompts from templates.

    Prompts are filled in and answers are read and repaired by expressions; only the calls themselves run in Python, with
    retries, at most ``workers`` at once and ``per_second`` a second. ``post`` should ask for ``response_schema``'s form.
    Labels outside the fixed ones become null.
    """

    def __init__(self, post: Post, first_prompt: str, second_prompt: str, workers: int = 3, per_second: float | None = None, **calling):
        self.post, self.prompts, self.calling = post, (first_prompt, second_prompt), {"workers": workers, "per_second": per_second, **calling}

    def _ask(self, articles: DataFrame, template: str, schema: str, reasons: list[str], allowed: dict[str, list[str]]) -> DataFrame:
        from pyspark.sql.types import StructType

        names = StructType.fromDDL(schema).names
        base = articles.drop(*names, "reasoning", "status", "error", "calls", "answer")
        # what the first pass found is part of the second one's prompt
        prompt = render_column(template, {c: F.col(c) for c in articles.columns})
        asked = articles.withColumn("_prompt", prompt).select(*base.columns, "_prompt")
        read = answers(call_model(asked, "_prompt", self.post, **self.calling), f"{schema}, {_reasons(reasons)}").drop("_prompt")
        cell = lambda n: F.when(F.col("answer")[n].isin(*allowed[n]), F.col("answer")[n]) if n in allowed else F.col("answer")[n]
        return read.withColumns({n: cell(n) for n in names} | {"reasoning": F.col("answer")["reasoning"]}).drop("answer")

    def first_pass(self, articles: DataFrame) -> DataFrame:
        allowed = {"brand_relevance": BRAND_RELEVANCE, "sentiment_stage": SENTIMENT_STAGES, "news_category": NEWS_CATEGORIES}
        return post_process(self._ask(articles, self.prompts[0], LABELS, FIRST_REASONS, allowed))

    def second_pass(self, articles: DataFrame) -> DataFrame:
        return self._ask(articles, self.prompts[1], DANGER, SECOND_REASONS, {"danger_level": DANGER_LEVELS, "issue_category": ISSUE_CATEGORIES})


def post_process(df: DataFrame) -> DataFrame:
    """An unrelated article is neutral and of no category."""
    off = F.col("brand_relevance") == "무관"
    return df.withColumns(
        {"sentiment_stage": F.when(off, "중립").otherwise(F.col("sentiment_stage")), "news_category": F.when(off, UNRELATED_CATEGORY).otherwise(F.col("news_category"))}
    )


def needs_classification() -> Column:
    """Not classified yet, and with an id."""
    done = F.char_length(clean_invisible(F.col("classified_at"))) > 1
    return ~done & (F.char_length(clean_invisible(F.col("article_id"))) >= 6)


def negative_gate() -> Column:
    return F.col("sentiment_stage").isin(*NEGATIVE_STAGES)


def verified_source(relevance: Column, sentiment: Column, category: Column) -> Column:
    """The rule that decides whether a cluster is a press release or a similar topic."""
    blank = F.coalesce(relevance, F.lit("")) == ""
    related = relevance == "관련"
    return (
        F.when(blank | (relevance == "판단 필요"), PRESS_RELEASE)
        .when(related & sentiment.isin(*NEGATIVE_STAGES), SIMILAR_TOPIC)
        .when(related & (sentiment == "긍정"), PRESS_RELEASE)
        .when(related & (sentiment == "중립") & category.isin(*PR_CATEGORIES), PRESS_RELEASE)
        .otherwise(SIMILAR_TOPIC)
    )


def component_gate(mode: str) -> Column:
    """Whether a component's classified representative lets the component stand."""
    if mode == "press_release":
        return (F.col("brand_relevance") == "관련") & ~F.col("sentiment_stage").isin(*NEGATIVE_STAGES) & F.col("news_category").isin(*PR_CATEGORIES)
    return F.col("brand_relevance").isin("관련", "언급") & (F.col("news_category") != UNRELATED_CATEGORY)


LABEL_COLUMNS = [*FIRST_PASS, "danger_level", "issue_category", "classified_at"]
REASONS = [*FIRST_REASONS, *SECOND_REASONS]
_LABELLED = f"{LABELS}, {DANGER}, classified_at string, " + ", ".join(f"{c} string" for c in REASONS) + ", status string, second_status string, error string"


def _whole(answer: DataFrame, reasons: list[str]) -> DataFrame:
    """An answer with a status (ok where the classifier has none), an error and its reasons as columns."""
    cols = set(answer.columns)
    out = answer.withColumns({c: F.lit(v).cast("string") for c, v in (("status", "ok"), ("error", None)) if c not in cols})
    kind = answer.schema["reasoning"].dataType if "reasoning" in cols else None
    inside = set(kind.names) if kind is not None and hasattr(kind, "names") else set()
    given = lambda r: F.col("reasoning")[r] if r in inside else F.col(r) if r in cols else F.lit(None)
    return out.withColumns({r: given(r).cast("string") for r in reasons})


def label(rows: DataFrame, classifier: Classifier, now: str) -> tuple[DataFrame, dict[str, int]]:
    """(row, label columns, reasons, statuses of the rows as a written table, counts of asked, success, failed, calls).

    The second pass asks about negative articles that the first one answered, and is told what it found. A row whose first
    answer failed has blank labels; a failed second answer leaves the first as it is. Counts come from the writing itself.
    """
    # written before the second pass asks for it: a model is called once for each article
    first = _whole(classifier.first_pass(rows.select("row", "query", "group", "title", "description")), FIRST_REASONS)
    first = materialise(first, "first_pass")
    ok = F.col("status") == "ok"
    second = classifier.second_pass(first.where(ok & negative_gate()).select("row", "query", "group", "title", "description", "brand_relevance", "sentiment_stage"))
    second = _whole(second, SECOND_REASONS).select("row", "danger_level", "issue_category", *SECOND_REASONS, F.col("status").alias("second_status"), F.col("error").alias("_error"))
    both = first.select("row", *FIRST_PASS, *FIRST_REASONS, "status", "error").join(second, "row", "left")
    blank = lambda c: F.when(ok, F.col(c)).otherwise(F.array().cast("array<string>") if c.endswith("keywords") else F.lit(""))
    both = both.withColumns(
        {c: blank(c) for c in FIRST_PASS}
        | {c: F.coalesce(F.when(F.col("second_status") == "ok", F.col(c)), F.lit("")) for c in ("danger_level", "issue_category")}
        | {"classified_at": F.lit(now), "error": F.coalesce("error", "_error")}
    )
    seen, again = Observation(), F.col("second_status").isNotNull()
    both = both.select("row", *LABEL_COLUMNS, *REASONS, "status", "second_status", "error").observe(
        seen, F.count(F.lit(1)).alias("asked"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"),
        F.count_if(again).alias("second_asked"), F.count_if(F.col("second_status") == "ok").alias("second_success"),
    )
    written = materialise(both, "labels")
    return written, dict(seen.get)


def with_label_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("array<string>" if c.endswith("keywords") else "string") for c in LABEL_COLUMNS if c not in df.columns})


#: Gets a phase's labels with reasons and statuses, by the row that was asked about, and their counts.
Report = Callable[[DataFrame, dict[str, int]], None]


def classify_press_releases(df: DataFrame, classifier: Classifier, now: str, report: Report | None = None) -> DataFrame:
    """Each press-release cluster's earliest article is classified and its labels go to the whole cluster.

    Reasons stay with the article that was asked about: ``report`` gets them. Counts also have propagated: rows that took labels.
    """
    df = with_label_columns(df)
    press = df.where((F.col("source") == PRESS_RELEASE) & non_blank(F.col("cluster_id")).isNotNull())
    reps = representatives(press, "cluster_id", "pub_datetime", "row").select("row", "query", "group", "title", "description", "cluster_id")
    reps = materialise(reps, "press_representatives")
    labels, counts = label(reps, classifier, now)
    labels = materialise(labels.join(reps.select("row", "cluster_id"), "row"), "press_labels")
    if report:
        taken = press.join(labels.select("cluster_id"), "cluster_id", "left_semi").count()
        report(labels, counts | {"propagated": taken})
    marked = df.withColumn("_press", F.when(F.col("source") == PRESS_RELEASE, F.col("cluster_id")))
    out = propagate(marked, labels.select(F.col("cluster_id").alias("_press"), *LABEL_COLUMNS), "_press", LABEL_COLUMNS)
    return out.drop("_press")


def classify_articles(
    df: DataFrame, classifier: Classifier, now: str, report: Report | None = None, chunk: int | None = None, save: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Every article that still needs it is classified on its own.

    With ``chunk``, so many at a time, by row: a chunk's labels are written when it is done, and ``save`` gets its rows with
    them, so that a phase that ends early keeps what it has. Where a chunk itself fails its rows count as failed.
    """
    df = with_label_columns(df)
    todo = df.where(needs_classification())
    if chunk is None:
        labels, counts = label(todo, classifier, now)
        if report:
            report(labels, counts)
        return propagate(df, labels, "row", LABEL_COLUMNS)
    spark, path, total = df.sparkSession, temporary(df.sparkSession, "labels"), Counter()
    schema = f"row {df.schema['row'].dataType.simpleString()}, {_LABELLED}"
    keep = lambda rows: rows.select("row", *LABEL_COLUMNS, *REASONS, "status", "second_status", "error")

    def work(rows: DataFrame) -> DataFrame:
        labels, counts = label(rows, classifier, now)
        total.update(counts)
        return labels

    def done(labels: DataFrame) -> None:
        keep(labels).write.mode("append").parquet(path)

    def failed(rows: DataFrame, why: str) -> None:
        if "second_status" not in rows.columns:  # the chunk as a whole: nothing of it was answered
            total.update({"asked": n, "failed": n} if (n := rows.count()) else {})
            none = {c: F.array().cast("array<string>") if c.endswith("keywords") else F.lit("") for c in LABEL_COLUMNS}
            none |= {c: F.lit(None).cast("string") for c in [*REASONS, "second_status"]} | {"error": F.lit(why), "classified_at": F.lit(now)}
            rows = rows.withColumns(none)
        done(rows)

    def sync(k: int, chunks: int, success: int, bad: int) -> None:
        if save and exists(spark, path):
            labels = spark.read.schema(schema).parquet(path)
            low, high = (k - 1) * chunk, k * chunk
            save(propagate(numbered.where(F.col("_number").between(low + 1, high)).drop("_number"), labels, "row", LABEL_COLUMNS))

    numbered = materialise(row_numbers(todo, [F.col("row").asc()], "_number"), "numbered_articles") if save else None
    run_in_chunks(todo, [F.col("row").asc()], work, done, failed, sync, chunk)
    labels = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    if report:
        report(labels, dict(total))
    return propagate(df, labels, "row", LABEL_COLUMNS)


def reasons_of(labels: DataFrame) -> DataFrame:
    """The labels' rows that have any reason of the first pass; the second pass's go only with these."""
    return labels.where(F.coalesce(*[non_blank(F.col(c)) for c in FIRST_REASONS]).isNotNull())


def verify_clusters(df: DataFrame, judge: ClusterJudge | None = None) -> DataFrame:
    """Each press-release cluster gets the source that ``judge`` finds, or else the one its first row's labels ask for."""
    press = df.where(F.col("source") == PRESS_RELEASE).withColumn("_c", F.coalesce("cluster_id", F.lit("")))
    first = press.groupBy("_c").agg(F.min_by(F.struct("brand_relevance", "sentiment_stage", "news_category"), "row").alias("s"))
    verdict = first.select("_c", verified_source(F.col("s.brand_relevance"), F.col("s.sentiment_stage"), F.col("s.news_category")).alias("_v"))
    if judge:
        given = judge(cluster_prompts(press.drop("cluster_id").withColumnRenamed("_c", "cluster_id"))).select(F.col("cluster_id").alias("_c"), "source_type")
        verdict = verdict.join(given, "_c", "left").select("_c", F.coalesce("source_type", "_v").alias("_v"))
    verdict = materialise(verdict, "cluster_verdicts")
    out = df.withColumn("_k", F.when(F.col("source") == PRESS_RELEASE, F.coalesce("cluster_id", F.lit("")))).join(verdict, F.col("_k") == F.col("_c"), "left")
    return out.withColumn("source", F.coalesce("_v", "source")).drop("_k", "_c", "_v")


def component_judge(classifier: Classifier, mode: str = "topic") -> Judge:
    """The judge that classifies a borderline component's representative and asks ``component_gate``."""
    return lambda reps: classifier.first_pass(reps).where(component_gate(mode)).select("row")


def verify_and_regroup(
    df: DataFrame, classifier: Classifier | None = None, report: Callable[[dict[str, int]], None] | None = None, cluster_judge: ClusterJudge | None = None
) -> DataFrame:
    """Cluster verdicts, merge across queries, topics, then the consistency rules.

    With a classifier, borderline components are judged by their representatives; without one they are left out.
    ``report`` gets the counts of what changed.
    """
    from .clusters import consistent

    judge = component_judge(classifier) if classifier else None
    # each step reads its input several times: a written table keeps plans from doubling at every step
    verified = materialise(verify_clusters(df, cluster_judge), "verified")
    merged = materialise(merge_across(verified, judge=judge), "merged_across")
    topics = materialise(group_topics(merged, judge=judge), "topics")
    if report:
        report(_changes(df, verified, merged, topics))
    grouped = materialise(consistent(topics), "grouped")
    return first_summary(grouped, "cluster_id", "cluster_summary", "row")


def _changes(before: DataFrame, verified: DataFrame, merged: DataFrame, topics: DataFrame) -> dict[str, int]:
    """Counts of articles and clusters that each step changed, by one aggregate over the steps' sources and cluster ids."""
    step = lambda df, n: df.select("row", F.col("source").alias(f"s{n}"), F.coalesce("cluster_id", F.lit("")).alias(f"c{n}"))
    all_ = step(before, 0).join(step(verified, 1), "row").join(step(merged, 2), "row").join(step(topics, 3), "row")
    press, joined, topic = F.col("s0") == PRESS_RELEASE, ~F.col("c2").eqNullSafe(F.col("c1")) | ~F.col("s2").eqNullSafe(F.col("s1")), F.col("c3") != F.col("c2")
    got = all_.agg(
        F.count_distinct(F.when(press, F.col("c0"))).alias("sv_clusters_verified"),
        F.count_if(press & (F.col("s1") == PRESS_RELEASE)).alias("sv_kept_press_release"),
        F.count_if(press & (F.col("s1") == SIMILAR_TOPIC)).alias("sv_reclassified_similar_topic"),
        F.count_distinct(F.when(joined, F.col("c2"))).alias("sv_cross_merged_groups"), F.count_if(joined).alias("sv_cross_merged_articles"),
        F.count_distinct(F.when(topic, F.col("c3"))).alias("sv_new_topic_groups"), F.count_if(topic).alias("sv_new_topic_articles"),
    )
    return got.first().asDict()


def summarise_clusters(df: DataFrame, summarise: Callable[[Column], Column] | None = None, by_group: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Clusters without any summary get one from their earliest title: ``summarise``, else its first 15 characters.

    by_group: what summarises clusters (cluster_id, title, description) instead, as ``judges.summaries_by_model`` gives.
    """
    df = df if "cluster_summary" in df.columns else df.withColumn("cluster_summary", F.lit(None).cast("string"))
    make = summarise or (lambda title: F.substring(F.coalesce(title, F.lit("")), 1, 15))
    clustered = df.where(non_blank(F.col("cluster_id")).isNotNull())
    with_any = clustered.where(non_blank(F.col("cluster_summary")).isNotNull()).select("cluster_id").distinct()
    reps = first_values(clustered.join(with_any, "cluster_id", "left_anti"), "cluster_id", "pub_datetime", "row", ["title", "description"] if by_group else ["title"])
    fresh = by_group(reps) if by_group else reps.select("cluster_id", make(F.col("title")).alias("cluster_summary"))
    return first_summary(propagate(df, fresh, "cluster_id", ["cluster_summary"]), "cluster_id", "cluster_summary", "row")


def other_articles(df: DataFrame, least: int = 3, category: str = "issue_category") -> DataFrame:
    """Articles of the category for everything else, if there are ``least`` or more of them."""
    other = df.where(F.col(category) == OTHER_CATEGORY)
    return other.crossJoin(F.broadcast(other.agg(F.count(F.lit(1)).alias("_n")))).where(F.col("_n") >= least).drop("_n")


SUGGESTION = "category_name string, count bigint, rationale string, article_ids array<string>"


def discover_categories(df: DataFrame, suggest: Callable[[list[str]], list[dict] | None], least: int = 3, batch: int = 500) -> DataFrame:
    """New categories that ``suggest`` proposes for the articles that fit none: SUGGESTION's columns.

    ``suggest`` gets one line an article ("- [id] title / summary", else the description's first 80 characters) in Arrow
    batches of at most ``batch`` lines, as much as a model's prompt holds; no answer proposes nothing. Proposals of one
    name are added up, with the rationale that sorts first. Fewer than ``least`` articles, or no column of issue
    categories, give no rows. A name that is blank or the category for everything else is left out.
    """
    import pandas as pd

    if "issue_category" not in df.columns:
        return df.sparkSession.createDataFrame([], SUGGESTION)
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")
    detail = F.coalesce(non_blank(text("news_keyword_summary")), F.substring(text("description"), 1, 80))
    lines = other_articles(df, least).select(F.concat(F.lit("- ["), text("article_id"), F.lit("] "), text("title"), F.lit(" / "), detail).alias("line"))

    def ask(frames):
        for f in frames:
            for at in range(0, len(f), batch):
                got = suggest(f["line"].iloc[at : at + batch].tolist()) or []
                rows = [(g.get("category_name"), int(g.get("count") or 0), g.get("rationale") or "", list(g.get("article_ids") or [])) for g in got]
                yield pd.DataFrame(rows, columns=["category_name", "count", "rationale", "article_ids"])

    each = materialise(lines.mapInPandas(ask, SUGGESTION), "suggestions")
    each = each.where(non_blank(F.col("category_name")).isNotNull() & (F.col("category_name") != OTHER_CATEGORY))
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("article_ids"))))
    return each.groupBy("category_name").agg(F.sum("count").alias("count"), F.min("rationale").alias("rationale"), ids.alias("article_ids"))


def response_schema(second: bool = False) -> dict:
    """JSON schema of a model's answer for either pass, with the labels as enumerations."""
    text = {"type": "string"}
    reasons = SECOND_REASONS if second else FIRST_REASONS
    own = (
        {"danger_level": {"type": ["string", "null"], "enum": [*DANGER_LEVELS, None]}, "issue_category": {"type": ["string", "null"], "enum": [*ISSUE_CATEGORIES, None]}}
        if second
        else {
            "brand_relevance": {"type": "string", "enum": BRAND_RELEVANCE},
            "brand_relevance_query_keywords": {"type": "array", "items": text, "minItems": 0, "maxItems": 3},
            "sentiment_stage": {"type": "string", "enum": SENTIMENT_STAGES},
            "news_category": {"type": "string", "enum": NEWS_CATEGORIES},
            "news_keyword_summary": {"type": "string", "maxLength": 50},
        }
    )
    reasoning = {"type": "object", "additionalProperties": False, "required": reasons, "properties": {r: text for r in reasons}}
    return {"type": "object", "additionalProperties": False, "required": ["reasoning", *own], "properties": {"reasoning": reasoning, **own}}


