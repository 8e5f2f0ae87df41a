"""The coverage pipeline: stored raw articles to classified results and reports, in five run modes.

    python -m newsloom.plans.coverage --store DIR [--mode full] [--now TEXT]
"""

from __future__ import annotations

import argparse
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings, load_settings
from ..constants import FIRST_REASONS, PRESS_RELEASE, REASONING_COLUMNS, RESULT_COLUMNS, SECOND_REASONS
from ..functions.dates import parse_pubdate, pubdate_iso
from ..functions.scores import cost_of
from ..functions.text import article_id, cluster_number, non_blank, strip_html
from ..operators import audit, classify, clusters, keyed, reports
from ..operators.judges import ClusterJudge
from ..sources import search
from ..sources.tables import Table, filter_by_best_date, on_or_after
from ..storage import materialise
from .runlog import RunLog

MODES = ("dry_run", "raw_only", "preprocess_only", "recheck_only", "full")


def run_mode(dry_run: bool = False, raw_only: bool = False, preprocess_only: bool = False, recheck_only: bool = False) -> str:
    """The first mode asked for, in order of precedence."""
    asked = (dry_run, raw_only, preprocess_only, recheck_only, True)
    return next(m for m, a in zip(MODES, asked, strict=True) if a)


def normalise(raw: DataFrame, top_article: int = 0) -> DataFrame:
    """Stripped texts, parsed dates, ids, and cumulative numbers in order of publication."""
    out = raw.withColumns(
        {
            "title": strip_html(F.col("title")), "description": strip_html(F.col("description")), "published": parse_pubdate(F.col("pubDate")),
            "pub_datetime": pubdate_iso(F.col("pubDate")), "article_id": article_id(F.col("link")),
        }
    )
    if "article_no" not in out.columns:
        out = out.withColumn("article_no", F.lit(None).cast("string"))
    return keyed.number_rows(out, "article_no", "published", "link", top_article)


@dataclass(frozen=True)
class Judges:
    """A model's part in a run besides the classifier: verdicts on clusters, summaries, outlets of new domains."""

    clusters: ClusterJudge | None = None
    summaries: Callable[[DataFrame], DataFrame] | None = None
    outlets: Callable[[DataFrame], DataFrame] | None = None


def preprocess(
    raw: DataFrame, directory: DataFrame, top_article: int, top_cluster: int, settings: Settings, judges: Judges = Judges()
) -> tuple[DataFrame, DataFrame]:
    """(normalised, deduplicated articles with clusters, summaries and outlets; new outlets)."""
    rows = keyed.dedupe_latest(normalise(raw, top_article), "published", "link")
    rows = materialise(rows.withColumn("row", F.col("article_no")), "normalised").withColumn("iso", F.col("pub_datetime")).withColumn("pub_datetime", F.col("published"))
    found = materialise(clusters.detect_press_releases(rows, settings.press_release, top_cluster), "detected")
    named = materialise(classify.summarise_clusters(found, by_group=judges.summaries), "summarised")
    return reports.add_outlets(named, directory, judges.outlets)


TABLES = ("raw_data", "total_result", "media_directory", "reasoning", "keywords", "run_history", "errors", "events")


def _result_rows(rows: DataFrame, settings: Settings) -> DataFrame:
    """Rows as the result table holds them: strings of its columns, dated on or after the start date."""
    dated = reports.add_time_columns(rows).withColumn("pub_datetime", F.col("iso"))
    text = {c: (F.to_json(c) if c.endswith("keywords") else F.col(c).cast("string")) if c in dated.columns else F.lit("") for c in RESULT_COLUMNS}
    return filter_by_best_date(dated.select(*[v.alias(c) for c, v in text.items()]), settings.date_filter_start)


def _save(tables: dict[str, Table], rows: DataFrame, settings: Settings, log: RunLog, stage: str) -> int:
    """Upserts a stage's rows, so that a later failure costs only what came after. A failed save is logged, not raised."""
    try:
        got = tables["total_result"].upsert(materialise(_result_rows(rows, settings), "result").withColumn("row_pos", F.monotonically_increasing_id()), force=True)
    except Exception as error:  # whatever the store answers: the run goes on and the next stage saves again
        log.error("sync", stage, "the stage could not be saved", error=str(error)[:500])
        return 0
    log.event("sync", stage, "stage saved", added=got["added"], updated=got["updated"])
    return got["added"] + got["updated"]


def reasoning_rows(rows: DataFrame, now: str) -> DataFrame:
    """The reasoning table's rows, all strings, of articles whose classifier gave any reason; absent columns are ''."""
    have = [c for c in FIRST_REASONS + SECOND_REASONS if c in rows.columns]
    if not have:
        return rows.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in REASONING_COLUMNS))
    some = rows.where(F.coalesce(*[non_blank(F.col(c)) for c in have]).isNotNull())
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("") for c in REASONING_COLUMNS} | {"classified_at": F.lit(now)}
    return some.select(*[v.alias(c) for c, v in cells.items()])


def run(
    spark: SparkSession, store: str, mode: str = "full", classifier: classify.Classifier | None = None, settings: Settings | None = None,
    now: str = "", collected: DataFrame | None = None, run_id: str = "run", limit: int | None = None, chunk: int | None = None,
    transport: search.Transport | None = None, judges: Judges = Judges(),
) -> RunLog:
    """One run over the tables below ``store``; a dry run calls no classifier and writes no table.

    Rows are written to the shared folder between phases and saved into the result table after processing and after
    each classification phase; with ``chunk`` also after every so many classified articles, so that a phase that ends early
    keeps what it has. Counts of answers and failures come from the writing of the labels; reasons go to their own table.
    transport: what collects the settings' brands, each saved when its pages end; a brand that fails is logged.
    judges: what a model decides on groups; without one the rules do.
    limit: process only so many articles, the first by link. now: the stamp of the run, the present time if blank.
    """
    now = now or datetime.now(UTC).isoformat(timespec="seconds")
    settings, log, dry = settings or load_settings(), RunLog(run_id, now, mode), mode == "dry_run"
    tables = {t: Table(spark, f"{store}/{t}") for t in TABLES}
    if collected is not None and mode != "recheck_only" and not dry:
        log.start("collection")
        got = tables["raw_data"].upsert(materialise(collected, "collected").withColumn("row_pos", F.monotonically_increasing_id()))
        log.log(articles_collected_total=got["attempted"], existing_links_skipped=got["skipped"], sheets_rows_uploaded_raw=got["added"] + got["updated"])
        log.end("collection")
    if transport is not None and mode != "recheck_only" and not dry:
        log.start("collection")
        counts, errors = search.collect_into(tables["raw_data"], transport, settings.our_brands, settings.competitors)
        of = lambda name: sum(c[name] for c in counts.values())
        log.log(
            articles_collected_total=of("attempted"), articles_collected_per_query={k: c["attempted"] for k, c in sorted(counts.items())},
            existing_links_skipped=of("skipped"), sheets_rows_uploaded_raw=of("added") + of("updated"),
        )
        for brand, why in sorted(errors.items()):
            log.error("collection", brand, "the brand could not be collected", error=why)
        log.end("collection")
    raw = tables["raw_data"].read()
    if raw is None:
        if mode == "recheck_only":
            raise ValueError("there are no raw articles to check")
        return log
    if mode == "raw_only":
        return _finish(spark, log, tables, dry)
    result = tables["total_result"].read()
    todo = on_or_after(audit.reprocess_targets(raw, result), parse_pubdate(F.col("pubDate")), settings.date_filter_start)
    todo = materialise(todo if limit is None else todo.orderBy("link").limit(limit), "todo")
    targets = todo.count()
    log.log(reprocess_targets_total=targets)
    if not targets:
        return _finish(spark, log, tables, dry)
    log.start("processing")
    directory = tables["media_directory"].read("domain string, media_name string, media_group string, media_type string")
    top = result.agg(F.max(F.col("article_no").try_cast("bigint")), F.max(cluster_number(F.col("cluster_id"), "c"))).first() if result is not None else (0, 0)
    rows, outlets = preprocess(todo.drop("row_pos"), directory, top[0] or 0, top[1] or 0, settings, Judges() if dry else judges)
    rows, outlets = materialise(rows, "processed"), materialise(outlets, "outlets")
    stats = reports.distinct_clusters(rows).first()
    n = rows.count()
    log.log(articles_processed=n, duplicates_removed=targets - n, press_releases_detected=stats["articles"], press_release_groups=stats["groups"], press_release_avg_cluster_size=stats["avg_size"], media_domains_new=outlets.count())
    log.end("processing")
    if dry:
        return log
    tables["media_directory"].append(outlets)
    saved = _save(tables, rows, settings, log, "processing")
    if mode in ("full", "recheck_only"):
        model = classifier or classify.RuleClassifier()
        spent = lambda articles: round(cost_of(articles), 4)

        def reported(labels: DataFrame) -> None:
            asked = rows.select("row", "article_id").join(classify.reasons_of(labels), "row")
            reasons = materialise(reasoning_rows(asked, now), "reasons")
            if not reasons.isEmpty():
                tables["reasoning"].backfill(REASONING_COLUMNS)
                tables["reasoning"].append(reasons)

        def press_done(labels: DataFrame, n: dict[str, int]) -> None:
            log.log(pr_clusters_analyzed=n["asked"], pr_articles_propagated=n["propagated"], pr_llm_success=n["success"], pr_llm_failed=n["failed"], pr_cost_estimated=spent(n["success"]))
            reported(labels)

        def articles_done(labels: DataFrame, n: dict[str, int]) -> None:
            n = Counter(n)
            log.log(articles_classified_llm=n["success"], llm_api_calls=n["success"] + n["second_success"], classification_errors=n["failed"], llm_cost_estimated=spent(n["success"]))
            reported(labels)

        log.start("pr_classification")
        rows = materialise(classify.classify_press_releases(rows, model, now, press_done), "press_classified")
        saved = _save(tables, rows, settings, log, "pr_classification")
        log.end("pr_classification")
        log.start("general_classification")
        log.log(press_releases_skipped=rows.where((F.col("source") == PRESS_RELEASE) & ~classify.needs_classification()).count())
        part = lambda done: _save(tables, done, settings, log, "general_classification_chunk")
        rows = materialise(classify.classify_articles(rows, model, now, articles_done, chunk, part), "classified")
        saved = _save(tables, rows, settings, log, "general_classification")
        log.end("general_classification")
        log.start("source_verification")
        rows = materialise(classify.verify_and_regroup(rows, classifier, lambda n: log.log(**n), judges.clusters), "verified")
        rows = materialise(classify.summarise_clusters(rows, by_group=judges.summaries), "regrouped")
        saved = _save(tables, rows, settings, log, "source_verification")
        log.end("source_verification")
    log.log(sheets_rows_uploaded_result=saved)
    whole = tables["total_result"].read()
    if whole is not None:
        log.log(**reports.kpis(whole).first().asDict())
        words = reports.keyword_table(whole, reports.word_list(F.concat_ws(" ", "title", "description")))
        if words is not None:
            tables["keywords"].overwrite(words)
    return _finish(spark, log, tables, dry)


def _finish(spark: SparkSession, log: RunLog, tables: dict[str, Table], dry: bool) -> RunLog:
    if not dry:
        for level, name in (("error", "errors"), ("event", "events")):
            rows = log.flush(spark, level)
            if rows.limit(1).count():
                tables[name].append(rows)
        tables["run_history"].append(log.history(spark))
    return log


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--store", required=True)
    p.add_argument("--now", default="")
    p.add_argument("--settings")
    p.add_argument("--limit", type=int)
    p.add_argument("--chunk_size", type=int)
    for m in MODES[:-1]:
        p.add_argument(f"--{m}", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    log = run(spark, a.store, run_mode(a.dry_run, a.raw_only, a.preprocess_only, a.recheck_only), settings=load_settings(a.settings), now=a.now, limit=a.limit, chunk=a.chunk_size)
    for k, v in log.metrics.items():
        print(f"{k}: {v}")
    if "total_result_count" in log.metrics:
        print(reports.headline(log.metrics))


if __name__ == "__main__":
    main()
