"""Small fixtures for the library's own operators; the queries are also held against DuckDB SQL (test_queries.py)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.config import PressRelease, load_settings
from newsloom.functions import dates, json, scores, text
from newsloom.operators import audit, chunks, classify, clusters, keyed, reports, similarity
from newsloom.plans import coverage
from newsloom.sources import search
from newsloom.sources.tables import Table, clean_table, filter_by_best_date, known_keys, migrate_group_labels, read_strings, write_csv


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_text_functions(spark):
    lit = F.lit
    r = one(
        spark, text.strip_html(lit(" <b>A &lt;b&gt; &amp;lt; &#8217;&#x1F600;</b> ")), text.strip_html(lit(None).cast("string")), text.clean_markup(lit("a<br>b&quot;c  &amp; d")),
        text.clean_invisible(lit("﻿ a​b \x01 ")), text.tokens(lit("Hotel 서울 a é-Bar bar")), text.summary_tokens(lit("  a  b a ")),
        text.char_grams(lit("AB  c"), 3, 4), text.article_id(lit(" ")), text.domain(lit("https://www.a.b:80/x?y")), text.domain(lit("nothing")),
        text.normalise_group(lit(" OUR ")), text.cluster_label(lit("q"), "c", lit(7)), text.cluster_label(lit("q"), "c", lit(1234567)), text.cluster_number(lit("x_c00012"), "c"),
        text.cluster_number(lit("x_t00012"), "c"), text.query_prefix(lit("a|b")), text.jaccard(F.array(), F.array(lit("a"))),
    )
    assert list(r) == [
        "A <b> &lt; ’\U0001f600", "", 'a b c & d', "ab", ["hotel", "서울", "bar"], ["a", "b"], ["ab ", "b c", "ab c"], "", "a.b:80", "", "자사",
        "q_c00007", "q_c1234567", 12, None, "a", 0.0,
    ]
    assert text.header_key("﻿Link ") == "link" and text.column_letter(27) == "AA" and text.render("{{a}} {{b}}", {"a": 1}) == "1 {{b}}"


def test_dates_and_scores(spark):
    p = F.lit("Thu, 12 Feb 2026 00:30:00 +0900")
    r = one(spark, dates.pubdate_iso(p), dates.parse_pubdate(p), dates.pubdate_iso(F.lit("bad")), dates.iso_week(F.lit("2027-01-01").cast("timestamp")), dates.iso_week(F.lit(None).cast("timestamp")), F.round(scores.cost(F.lit(1)), 9))
    assert list(r) == ["2026-02-12T00:30:00+09:00", datetime(2026, 2, 11, 15, 30), None, "2026-53", "", 0.000405]
    assert scores.backoff(0, 429, jitter=1) == 21 and scores.backoff(2, 503) == 32 and scores.backoff(1, None) == 4 and scores.backoff(0, 429, 1.0) == 10


def test_json_answers(spark):
    pay = ['{"output_text": "{\\"summaries\\": [{\\"cluster_id\\": \\"a\\", \\"summary\\": \\"one\\"}]}"}', '{"output": [{"content": [{"type": "t", "text": "x {\\"summaries\\": [{\\"cluster_id\\": \\"b\\", \\"summary\\": \\"two\\"},]} y"}]}]}']
    got = [one(spark, json.summaries(json.response_text(F.lit(x))))[0] for x in pay]
    assert [[tuple(s) for s in g] for g in got] == [[("a", "one")], [("b", "two")]]
    assert one(spark, json.summaries(F.lit('[{"cluster_id": "c", "summary": "s"}]')))[0][0].summary == "s"
    assert one(spark, json.summaries(F.lit("none")))[0] is None


def test_upsert_scenarios(spark):
    def up(stored, names, new, new_names, **k):
        s = spark.createDataFrame([(i, *r) for i, r in enumerate(stored, 1)], "row_pos bigint, " + ", ".join(f"`{c}` string" for c in names))
        n = spark.createDataFrame([(i, *r) for i, r in enumerate(new, 1)], "row_pos bigint, " + ", ".join(f"`{c}` string" for c in new_names))
        table, counts = keyed.upsert(s, n, **k)
        return sorted(map(tuple, table.drop("row_pos").collect()), key=str), tuple(counts.first()), table.columns[1:]

    rows, counts, names = up([("old", "l1", "g", "")], ["title", "﻿Link ", "group", "brand_relevance"], [("q", "g", "new", "l1", "관련")], ["query", "group", "title", "link", "brand_relevance"])
    assert counts == (1, 0, 1, 0, 0) and rows == [("new", "l1", "g", "관련", "q")] and names == ["title", "Link", "group", "brand_relevance", "query"]
    rows, counts, names = up([("l1", "t")], ["link", "title"], [("l2", "t2", "g2")], ["link", "title", "group"])
    assert counts == (1, 1, 0, 0, 0) and names == ["link", "title", "group"] and rows == [("l1", "t", ""), ("l2", "t2", "g2")]
    rows, counts, _ = up([("t", "g")], ["title", "group"], [("l1", "t", "g")], ["link", "title", "group"])
    assert counts == (1, 0, 0, 0, 1) and rows == [("t", "g")]
    rows, counts, _ = up([("a", "x"), ("a", "y")], ["link", "source"], [("a", "﻿"), ("", "z"), ("", "z"), ("b", "p"), ("b", "q")], ["link", "source"])
    assert counts == (5, 4, 0, 1, 0) and rows == sorted([("a", "x"), ("a", "y"), ("", "z"), ("", "z"), ("b", "p"), ("b", "q")], key=str)
    rows, counts, _ = up([("a", "x"), ("a", "y")], ["link", "source"], [("a", "n")], ["link", "source"])
    assert rows == [("a", "n"), ("a", "x")]
    _, counts, _ = up([("a", "x")], ["link", "source"], [("a", "")], ["link", "source"], force=True)
    assert counts == (1, 0, 1, 0, 0)


def test_audit_scenarios(spark):
    raw = spark.createDataFrame([(f"l{i:02d}",) for i in range(1, 11)], "link string")
    cols = "link string, brand_relevance string, sentiment_stage string, source string, media_domain string, date_only string"
    full = [(f"l{i:02d}", "a", "b", "c", "d", "e") for i in range(1, 11)]
    assert audit.reprocess_targets(raw, None).count() == 10
    assert audit.reprocess_targets(raw, spark.createDataFrame(full, cols)).count() == 0
    assert audit.reprocess_targets(raw, spark.createDataFrame(full[:8], cols)).count() == 2
    bad = [list(x) for x in full[:8]]
    for row, col, v in ((1, 1, ""), (2, 2, "﻿"), (3, 3, ""), (4, 4, None), (5, 5, ""), (6, 1, ""), (6, 2, "")):
        bad[row][col] = v
    bad = spark.createDataFrame([tuple(x) for x in bad], cols)
    assert audit.reprocess_targets(raw, bad).count() == 8
    assert {r.field: r.missing for r in audit.missing_counts(bad).collect()} == {"brand_relevance": 2, "sentiment_stage": 2, "source": 1, "media_domain": 1, "date_only": 1}
    reset = keyed.reset_where(bad.withColumn("classified_at", F.lit("t")), raw.limit(1))
    assert reset.where("classified_at = ''").count() == 1 and keyed.reset_where(bad, raw).columns == bad.columns


ART = "row bigint, query string, title string, description string, pub_datetime timestamp"


def arts(spark, rows):
    return spark.createDataFrame(rows, ART)


def test_press_release_rules(spark):
    d = lambda n: datetime(2026, 2, n)
    t, other = "grand hotel opens new lounge in seoul today", "completely different words about the weather"
    long = "the hotel group said its lounge would open to guests and members from spring with music and food"
    rows = [
        (1, "b", t, "", d(1)), (2, "b", t, "", d(4)), (3, "b", t + " x", "", d(8)), (4, "b", t, "", None), (5, "a", other, long, d(1)),
        (6, "a", "short one here", long, d(20)), (7, "a", "nothing alike", "zzz", d(1)), (8, "c", t, "", d(1)), (9, "a", None, None, d(1)),
    ]
    seen = []
    for strategy in ("grid", "prefix"):
        w = similarity.gram_weights(clusters.comparable(arts(spark, rows)), "block", "row", "title", 2)
        got = {(r.i, r.j): r.cosine for r in similarity.cosine_pairs(w, 0.5, strategy).collect()}
        assert {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)} <= set(got) and got[1, 2] == pytest.approx(1.0)
        seen.append(got)
    assert seen[0] == pytest.approx(seen[1])
    out = {r.row: (r.source, r.cluster_id) for r in clusters.detect_press_releases(arts(spark, rows), PressRelease(), 5).collect()}
    assert out[5] == out[6] == ("보도자료", "a_c00006") and out[1] == out[2] == ("보도자료", "b_c00007")
    assert all(out[k] == ("일반기사", "") for k in (3, 4, 7, 8, 9))


class Only:
    """Approves, as a classifier, the articles of these rows."""

    def __init__(self, *rows):
        self.rows = rows

    def first_pass(self, articles):
        new = {"brand_relevance": F.when(F.col("row").isin(*self.rows), "관련").otherwise("무관"), "sentiment_stage": F.lit("중립"), "news_category": F.lit("PR/보도자료")}
        return articles.withColumns(new)


def test_borderline_components_are_judged(spark):
    d = lambda n: datetime(2026, 2, n)
    summaries = ["a b c d", "a b c x", "a b y z", "k l m n", "k l m o p q", "u v w"]
    rows = [(i, "q", "g", f"title{i}", f"text{i}", d(9 - i), "일반기사", "", "기타", s, "") for i, s in enumerate(summaries, 1)]
    rows += [(7, "p", "g", "grand hotel lounge opening", "one", d(1), "일반기사", "", "기타", "", ""), (8, "r", "g", "grand hotel lounge tomorrow evening", "two", d(2), "일반기사", "", "기타", "", "")]
    names = "row long, query string, `group` string, title string, description string, pub_datetime timestamp, source string, cluster_id string, news_category string, news_keyword_summary string, cluster_summary string"
    df = spark.createDataFrame(rows, names).withColumn("media_domain", F.lit("")).withColumn("link", F.lit(""))
    ids = lambda out: {r.row: r.cluster_id for r in out.collect() if r.cluster_id}
    plain = ids(clusters.group_topics(df))
    rules = {(r.i, r.j): r.rule for r in clusters.topic_pairs(df).collect()}
    assert rules == {(1, 2): "edge", (4, 5): "border"} and plain == {1: "q_t00001", 2: "q_t00001"}
    assert ids(clusters.group_topics(df, judge=classify.component_judge(Only(4)))) == plain
    assert ids(clusters.group_topics(df, judge=classify.component_judge(Only(5)))) == plain | {4: "q_t00002", 5: "q_t00002"}
    assert {(r.i, r.j): r.rule for r in clusters.cross_edges(df).collect()} == {(7, 8): "border"}
    assert ids(clusters.merge_across(df)) == ids(clusters.merge_across(df, judge=classify.component_judge(Only(8)))) == {}
    assert ids(clusters.merge_across(df, judge=classify.component_judge(Only(7)))) == {7: "cross_m00001", 8: "cross_m00001"}


def test_press_release_options(spark):
    d = lambda n: datetime(2026, 2, n)
    t = "grand hotel opens new lounge in seoul today"
    rows = [(i, q, t, "", d(1)) for i, q in enumerate(["a", "b", "c"], 1)]
    df = arts(spark, rows).withColumn("group", F.when(F.col("row") < 3, "OUR").otherwise("x"))
    assert {r.cluster_id for r in clusters.detect_press_releases(df).collect()} == {""}
    got = {r.row: r.cluster_id for r in clusters.detect_press_releases(df, group_our_brands=True).collect()}
    assert got == {1: "a_c00001", 2: "a_c00001", 3: ""}
    cfg = PressRelease(title_cosine=1.1, border_title_cosine=0.6)
    df = arts(spark, [(i, "a", t, "", d(i)) for i in (1, 2, 3)]).withColumn("group", F.lit("x"))
    out = lambda *rows: {r.cluster_id for r in clusters.detect_press_releases(df, cfg, judge=classify.component_judge(Only(*rows), "press_release")).collect()}
    assert out(1) == {"a_c00001"} and out(2, 3) == {""}


def test_verdicts_and_rules(spark):
    rows = [("", "중립", "x"), ("판단 필요", "중립", "x"), ("관련", "부정 후보", "시설/오픈"), ("관련", "긍정", "x"), ("관련", "중립", "시설/오픈"), ("관련", "중립", "기타"), ("언급", "긍정", "시설/오픈"), (None, None, None)]
    df = spark.createDataFrame(rows, "brand_relevance string, sentiment_stage string, news_category string")
    got = [r[0] for r in df.select(classify.verified_source(*map(F.col, df.columns))).collect()]
    assert got == ["보도자료", "보도자료", "유사주제", "보도자료", "보도자료", "유사주제", "유사주제", "보도자료"]


def test_batch_classifier_keeps_failures(spark):
    ask = lambda rows: [None if r["row"] == 2 else {"brand_relevance": "무관", "sentiment_stage": "긍정", "news_category": "기타", "brand_relevance_query_keywords": ["k"], "news_keyword_summary": "s"} for r in rows]
    df = spark.createDataFrame([(1, "q", "g", "t", "d"), (2, "q", "g", "t", "d")], "row long, query string, `group` string, title string, description string")
    got = {r.row: r for r in classify.BatchClassifier(ask, ask, workers=2, batch=1).first_pass(df).collect()}
    assert got[1].sentiment_stage == "중립" and got[1].news_category == "비관련" and got[2].status == "failed" and got[2].brand_relevance is None


def test_retries(spark):
    """400 and 401 raise at once, overload and server errors are tried again, others give up at once."""
    from newsloom.sources.retry import Refused, with_retries

    def run(*given, **options):
        todo, waits, said = list(given), [], []

        def send():
            x = todo.pop(0)
            if isinstance(x, Exception):
                raise x
            return x

        try:
            got = with_retries(send, sleep=waits.append, jitter=lambda: 0.5, notify=said.append, **options)
        except Refused as error:
            got = str(error)[:10]
        return got, waits, len(said), len(todo)

    assert run((200, None, "a")) == ("a", [], 0, 0)
    assert run((401, None, ""), (200, None, "a")) == ("answer 401", [], 1, 1) and run((400, None, "bad"))[0] == "answer 400"
    assert run((429, None, ""), (429, 3.0, ""), (429, 40.0, ""), (200, None, "a")) == ("a", [18.0, 13.0, 43.0], 3, 0)
    assert run((500, 99.0, ""), (503, None, ""), OSError("net"), (200, None, "a")) == ("a", [8.0, 16.0, 8.0], 3, 0)
    assert run(*[(500, None, "")] * 5) == (None, [8.0, 16.0, 32.0, 64.0], 5, 0) and run((429, None, ""), attempts=1) == (None, [], 1, 0)
    assert run((404, None, ""), (200, None, "a")) == (None, [], 1, 1) and run(*[OSError("x")] * 5)[:2] == (None, [2.0, 4.0, 8.0, 16.0])


def test_model_calls_are_bounded_and_fail_alone(spark, tmp_path):
    from newsloom.sources.model import call_model

    def post(prompt):
        import os
        import time

        open(tmp_path / f"{os.getpid()}-{time.monotonic_ns()}", "w").close()
        if prompt == "p3":
            return 401, None, "key"
        if prompt == "p4":
            raise ValueError("odd")
        return (429, 0.0, "") if prompt == "p5" else (200, None, prompt)

    df = spark.createDataFrame([(i, f"p{i}") for i in range(12)], "k int, prompt string").repartition(6)
    called = call_model(df, "prompt", post, workers=2, per_second=50, attempts=2, sleep=lambda s: None)
    got = {r.k: r for r in called.collect()}
    assert {k for k, r in got.items() if r.status == "failed"} == {3, 4, 5} and got[7].payload == "p7" and got[5].calls == 2 and got[0].calls == 1
    assert "401" in got[3].error and "ValueError" in got[4].error and "429" in got[5].error
    assert len({f.name.split("-")[0] for f in tmp_path.iterdir()}) <= 2
    assert called.rdd.getNumPartitions() == 2


def model_rows(n):
    return [(i, f"id{i:06d}", "q", "g", f"t{i}", "d", "일반기사", "", None) for i in range(n)]


ROWS = "row long, article_id string, query string, `group` string, title string, description string, source string, cluster_id string, pub_datetime timestamp"


def answering():
    """A function of its own, so that executors get it by value."""

    def answer(r, **more):
        return {"brand_relevance": "관련", "sentiment_stage": "부정 후보", "news_category": "기타", "brand_relevance_query_keywords": ["k"], "news_keyword_summary": "s", "danger_level": "중", "issue_category": "기타"} | more

    return answer


def test_reasons_and_counts_of_a_phase(spark):
    answer = answering()
    first = lambda rows: [None if r["row"] == 2 else answer(r, reasoning={"article_subject": f"about {r['row']}", "brand_role": "주체"} if r["row"] != 3 else None) for r in rows]
    second = lambda rows: [None if r["row"] == 1 else answer(r, reasoning={"severity_analysis": r["sentiment_stage"]}) for r in rows]
    labels, n = classify.label(spark.createDataFrame(model_rows(5), ROWS), classify.BatchClassifier(first, second, batch=2), "now")
    assert n == {"asked": 5, "success": 4, "failed": 1, "second_asked": 4, "second_success": 3}
    got = {r.row: r for r in labels.collect()}
    assert got[2].brand_relevance == "" and got[2].status == "failed" and got[2].classified_at == "now" and got[1].danger_level == "" and got[0].danger_level == "중"
    rows = coverage.reasoning_rows(classify.reasons_of(labels).withColumn("article_id", F.concat(F.lit("id"), "row")), "now").collect()
    assert sorted((r.article_id, r.article_subject, r.severity_analysis) for r in rows) == [("id0", "about 0", "부정 후보"), ("id1", "about 1", ""), ("id4", "about 4", "부정 후보")]


def test_a_phase_that_dies_keeps_its_chunks(spark):
    answer = answering()

    def first(rows):
        return [answer(r) for r in rows]

    class Dies(classify.BatchClassifier):
        asked = 0

        def first_pass(self, articles):
            Dies.asked += 1
            if Dies.asked == 3:
                raise OSError("gone")
            return super().first_pass(articles)

    saved, reported = [], []
    out = classify.classify_articles(
        spark.createDataFrame(model_rows(7), ROWS), Dies(first, first), "now", lambda labels, n: reported.append((labels.count(), n)), 2,
        lambda rows: saved.append(sorted((r.row, r.brand_relevance) for r in rows.collect())),
    )
    assert saved == [[(0, "관련"), (1, "관련")], [(2, "관련"), (3, "관련")], [(4, ""), (5, "")], [(6, "관련")]]
    assert reported == [(7, {"asked": 7, "success": 5, "failed": 2, "second_asked": 5, "second_success": 5})]
    assert {r.row: r.brand_relevance for r in out.collect()} == {i: "" if i in (4, 5) else "관련" for i in range(7)}


def test_judges_fall_back(spark):
    """Batches hold so many groups at most; one without an answer falls back, what wasn't asked about is passed over."""
    from newsloom.operators import judges

    def post(prompt):
        import json
        import re

        ids = re.findall(r"^\[(.*)\]$", prompt, re.M)
        if len(ids) > 2:
            return 400, None, "too long"
        if "c3" in ids:
            return 503, None, ""
        if "c5" in ids:
            return 200, None, json.dumps({"output_text": "sorry"})
        given = [{"cluster_id": x, "summary": s} for x in ids if x != "c1" for s in ("first", f"of {x}")] + [{"cluster_id": "other", "summary": "x"}]
        return 200, None, json.dumps({"output_text": json.dumps({"summaries": given})})

    groups = spark.createDataFrame([(f"c{i}", f"title of the cluster {i}", None) for i in range(8)], "cluster_id string, title string, description string")
    sized = judges.batches(groups, [F.col("cluster_id")], 3).collect()
    assert sorted((r.batch, [i.cluster_id for i in r["items"]]) for r in sized) == [(0, ["c0", "c1", "c2"]), (1, ["c3", "c4", "c5"]), (2, ["c6", "c7"])]
    got = judges.summaries_by_model(post, "{{items}}", size=2, attempts=1)(groups).collect()
    assert {r.cluster_id: r.cluster_summary for r in got} == {"c0": "of c0", "c2": "title of the cl", "c3": "title of the cl", "c4": "title of the cl", "c5": "title of the cl", "c6": "of c6", "c7": "of c7"}
    rows = [(i, "a", "q", "", f"t{i}", "관련" if i == 4 else "", "부정 후보", "x") for i in range(12)] + [(20, "b", "q", "s", "u", "관련", "긍정", "x")]
    press = spark.createDataFrame(rows, "row long, cluster_id string, query string, cluster_summary string, title string, brand_relevance string, sentiment_stage string, news_category string")
    shown = {r.cluster_id: r for r in judges.cluster_prompts(press).collect()}
    assert shown["a"].titles_list == "\n".join([*[f"- t{i}" for i in range(10)], "- ... and 2 more"]) and shown["a"].brand_relevance == "관련" and shown["a"].article_count == 12
    assert shown["b"].titles_list == "- u" and shown["b"].cluster_summary == "s"
    down = judges.cluster_judge(lambda prompt: (500, None, ""), "{{titles_list}}", attempts=1)
    verified = classify.verify_clusters(press.withColumn("source", F.lit("보도자료")), down)
    assert {(r.cluster_id, r.source) for r in verified.collect()} == {("a", "보도자료"), ("b", "보도자료")}
    named = judges.outlets_by_model(lambda prompt: (500, None, ""), "{{items}}", attempts=1)(spark.createDataFrame([("x.com",)], "domain string"))
    assert tuple(named.first()) == ("x.com", "x.com", "x.com", "기타")


def test_every_character_reference(spark):
    """As the standard library has it: all names, with and without semicolon and with letters behind, and numbers."""
    import html
    import random
    from html.entities import html5

    rnd = random.Random(1)
    names = sorted(html5)
    cases = [f"&{n}" for n in names] + [f"a&{n}b" for n in names[::7]] + [f"&{n.rstrip(';')}xyz; &" for n in names[::11]]
    cases += [f"&#{n};" for n in [*range(0, 300), 55295, 55296, 57343, 57344, 64976, 65007, 65534, 65535, 65536, 128512, 1114110, 1114111, 1114112, 99999999999]]
    cases += [f"&#x{n:x}{e}" for n in [0, 9, 13, 38, 128, 150, 159, 160, 55297, 65534, 128512, 2**40] for e in (";", "", "g", " ")]
    cases += ["&#;", "&#x;", "&;", "&", "&&amp;", "&amp;lt;", "&notit;", "&#0000038;", "a & b", "&ampamp;", "&#38#38;", "", "&noSuchName; &quot", "&" + "a" * 40 + ";"]
    bits = ["&", "amp", "lt", ";", "#", "x41", "65", "not", "in", " ", "<", "é", "quot"]
    cases += ["".join(rnd.choices(bits, k=rnd.randint(1, 9))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", text.decode_entities(F.col("t")).alias("d")).collect()}
    bad = [(t, got[i], html.unescape(t)) for i, t in enumerate(cases) if got[i] != html.unescape(t)]
    assert not bad, bad[:10]


def test_number_rows_and_islands(spark):
    df = spark.createDataFrame([("a", 3, None), ("b", None, None), ("c", 1, None), ("d", 1, "9")], "link string, ts int, no string")
    assert {r.link: r.no for r in keyed.number_rows(df, "no", "ts", "link", 9).collect()} == {"d": 9, "c": 10, "a": 11, "b": 12}
    got = keyed.islands(spark.createDataFrame([(x,) for x in (2, 3, 4, 7, 9, 10)], "r int"), "r").collect()
    assert sorted((r.first_row, r.last_row, r.rows) for r in got) == [(2, 4, 3), (7, 7, 1), (9, 10, 2)]


def test_buckets(spark):
    rows = [(0.65, 0.15, 0.0, 0.0), (0.0, 0.0, 0.55, 0.08), (0.58, 0.20, 0.0, 0.0), (0.0, 0.0, 0.48, 0.12), (0.64, 0.14, 0.47, 0.5)]
    df = spark.createDataFrame(rows, "t_cos double, t_jac double, d_cos double, d_jac double")
    assert [r[0] for r in df.select(reports.default_bucket()).collect()] == ["auto_title", "auto_desc", "border_title", "border_desc", "no_merge"]
    assert reports.sweep(df, [0.65], [0.15], [0.55], [0.08]).first().merge_pct == 40.0


def test_tables(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    assert t.read() is None and t.dedupe() == {"before": 0, "after": 0, "removed": 0}
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", ""), (3, "b", "y"), (4, "", "z")], "row_pos bigint, link string, source string")
    assert t.upsert(new)["added"] == 4
    assert t.dedupe() == {"before": 4, "after": 3, "removed": 1}
    assert sorted(r.link for r in known_keys(t.read()).collect()) == ["a", "b"]
    df = spark.createDataFrame([("﻿a ", "x"), ("b", None)], "link string, `group` string")
    cleaned, changed = clean_table(df)
    assert changed.first().changed == 1 and cleaned.first().link == "a"
    write_csv(df.withColumn("group", F.lit("OUR")), str(tmp_path / "csv"))
    back = read_strings(spark, str(tmp_path / "csv"))
    assert back.columns == ["link", "group"] and {r.group for r in migrate_group_labels(back).collect()} == {"자사"}
    assert filter_by_best_date(spark.createDataFrame([("2026-03-01", "x"), ("2026-01-01", "y")], "date_only string, k string"), "2026-02-01").count() == 1


def test_an_upsert_writes_what_changes(spark, tmp_path):
    """One key in a hundred: about a hundredth of the bytes. Readers see the newest rows; columns that come later are empty before."""
    import os

    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet"))
    t = Table(spark, str(tmp_path / "t"))
    rows = spark.range(100_000).select(F.col("id").alias("row_pos"), F.concat(F.lit("k"), "id").alias("link"), F.sha2(F.col("id").cast("string"), 256).alias("source"))
    t.overwrite(rows.coalesce(1))
    whole = size()
    some = rows.where("row_pos % 100 = 7").select("row_pos", "link", F.lit("new").alias("source"), F.lit("m").alias("month")).coalesce(1)
    assert t.upsert(some) == {"attempted": 1000, "added": 0, "updated": 1000, "skipped": 0, "errors": 0}
    assert size() - whole < 0.02 * whole
    again = some.where("row_pos < 1000").withColumn("source", F.lit("newer"))
    assert t.upsert(again)["updated"] == 10
    got = t.read()
    assert got.count() == 100_000 and got.where("source = 'new' and month = 'm'").count() == 990 and got.where("source = 'newer'").count() == 10
    assert got.where("month = ''").count() == 99_000 and got.where("month is null").count() == 0
    assert t.upsert(again) == {"attempted": 10, "added": 0, "updated": 0, "skipped": 10, "errors": 0}


def test_changes_are_folded(spark, tmp_path):
    import os

    t = Table(spark, str(tmp_path / "t"))
    for i in range(Table.MOST_CHANGES + 4):
        t.append(spark.createDataFrame([(i,)], "k long"))
        assert sorted(r.k for r in t.read().collect()) == list(range(i + 1))
    assert [e["kind"] for e in t._entries()] == ["base", "append", "append"]
    t.overwrite(spark.createDataFrame([(1,)], "k long"))
    t.overwrite(spark.createDataFrame([(2,)], "k long"))
    assert [r.k for r in t.read().collect()] == [2]
    assert len(os.listdir(tmp_path / "t" / "data")) == 2 and Table(spark, t.path).read().count() == 1


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    t = Table(spark, str(tmp_path / "a"))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: Table(spark, t.path).append(spark.createDataFrame([(i,)], "k long")), range(8)))
    assert sorted(r.k for r in t.read().collect()) == list(range(8))
    u = Table(spark, str(tmp_path / "u"))
    u.upsert(spark.createDataFrame([(0, "a", "x"), (1, "b", "x")], "row_pos long, link string, source string"))

    class Late(Table):
        """Another writer comes in between reading and committing."""

        late = True

        def _commit(self, number, kind, folder, **more):
            if self.late:
                self.late = False
                Table.upsert(Table(spark, self.path), spark.createDataFrame([(0, "b", "other"), (1, "c", "other")], "row_pos long, link string, source string"))
            return super()._commit(number, kind, folder, **more)

    got = Late(spark, u.path).upsert(spark.createDataFrame([(0, "c", "mine"), (1, "d", "mine")], "row_pos long, link string, source string"))
    assert got["added"] == 1 and got["updated"] == 1
    rows = u.read().collect()
    assert sorted((r.link, r.source) for r in rows) == [("a", "x"), ("b", "other"), ("c", "mine"), ("d", "mine")]
    assert len({r.row_pos for r in rows}) == 4


def test_blank_keys_meet_nobody(spark):
    """Nine rows in ten have a blank key: the plan brings none of them together, and all of them stay or are added."""
    rows = [(i, "" if i % 10 else f"k{i % 40}", "s") for i in range(400)]
    df = spark.createDataFrame(rows, "row_pos long, link string, source string")
    left = keyed.keep_one(df, "link", [F.col("row_pos")], keep_blank=True)
    assert left.count() == 364 and left.where("link <> ''").count() == 4
    parted = left.select("link", F.spark_partition_id().alias("p")).where("link = ''").groupBy("p").count().collect()
    assert len(parted) > 1 and max(r["count"] for r in parted) <= 2 * 360 / len(parted)
    _, stats = keyed.upsert(df, df)
    assert stats.first().asDict() == {"attempted": 400, "added": 360, "updated": 0, "skipped": 40, "errors": 0}


def test_sync_of_two_tables(spark, tmp_path):
    from newsloom.sources.tables import sync_tables

    raw, result = Table(spark, str(tmp_path / "raw")), Table(spark, str(tmp_path / "result"))
    rows = spark.createDataFrame([(0, "a", "2026-03-01"), (1, "b", "2025-01-01"), (2, "c", "no date")], "row_pos long, link string, date_only string")
    got = sync_tables(raw, result, rows, rows, "2026-02-01")
    assert got["all"] == {"attempted": 4, "added": 4, "updated": 0, "skipped": 0, "errors": 0} and [r.link for r in result.read().collect()] == ["a"]
    got = sync_tables(raw, result, rows, rows, "2026-02-01")
    assert got["raw_data"]["skipped"] == 3 and got["total_result"]["updated"] == 1 and got["all"]["attempted"] == 4


def test_duplicates_are_deleted(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    assert t.delete_duplicates() == (0, False)
    rows = [(2, "a", ""), (3, " a", "x"), (4, "a", "y"), (5, "", ""), (6, None, "x"), (7, "b", ""), (8, "b", None)]
    t.overwrite(spark.createDataFrame(rows, "row_pos long, `Original Link` string, `brand relevance` string"))
    left = lambda: sorted(r.row_pos for r in t.read().collect())
    assert t.delete_duplicates(dry_run=True) == (3, False) and len(left()) == 7
    assert t.delete_duplicates() == (3, False) and left() == [3, 5, 6, 7] and t.delete_duplicates() == (0, False)
    t.overwrite(spark.createDataFrame(rows, "row_pos long, original_link string, other string"))
    assert t.delete_duplicates(last=True) == (3, False) and left() == [4, 5, 6, 8]

    class Full(Table):
        tried = 0

        def overwrite(self, df):
            self.tried += 1
            raise OSError("full")

    full = Full(spark, t.path)
    assert full.delete(spark.createDataFrame([(4,), (99,)], "row_pos long")) == (0, True) and full.tried == 3 and left() == [4, 5, 6, 8]
    assert t.backfill(["Other ", "new"]) == 1 and t.read().columns == ["row_pos", "original_link", "other", "new"] and t.backfill(["new"]) == 0
    assert Table(spark, str(tmp_path / "n")).backfill(["a", "b"]) == 2
    assert text.find_column(["x", "B ", "A", "a"], ["c", "a", "b"]) == "A" and text.find_column([], ["a"]) is None


def test_chunks(spark):
    rows = spark.createDataFrame([(i,) for i in range(7)], "k long")
    good, bad, synced = [], [], []

    def work(df):
        if df.where("k = 4").count():
            raise ValueError("refused")
        return df.withColumn("status", F.when(F.col("k") == 1, "failed").when(F.col("k") != 2, "ok"))

    def sync(*counts):
        synced.append(counts)
        raise OSError("no store")

    got = chunks.run_in_chunks(rows, [F.col("k")], work, lambda d: good.extend(r.k for r in d.collect()), lambda d, why: bad.append((sorted(r.k for r in d.collect()), why)), sync, 3)
    assert got == {"processed": 7, "success": 2, "failed": 5, "chunks": 3, "sync_failed": 3} and sorted(good) == [0, 6]
    assert bad == [([1, 2], "no answer"), ([3, 4, 5], "ValueError: refused")] and synced == [(1, 3, 1, 2), (2, 3, 0, 3), (3, 3, 1, 0)]
    none = chunks.run_in_chunks(rows.where("k < 0"), [F.col("k")], work, good.append)
    assert none == {"processed": 0, "success": 0, "failed": 0, "chunks": 0, "sync_failed": 0}


def test_category_suggestions(spark):
    df = spark.createDataFrame([(f"id{i}", f"t{i}", "s" if i else " ", "long " * 40, "기타" if i < 5 else "평판/PR") for i in range(6)], "article_id string, title string, news_keyword_summary string, description string, issue_category string")

    def suggest(lines):
        if any("id0" in x for x in lines):
            assert any(x == "- [id0] t0 / " + ("long " * 40)[:80] for x in lines)
        return [{"category_name": "환경/소음", "count": len(lines), "rationale": "r", "article_ids": [x[3:6] for x in lines]}, {"category_name": "기타", "count": 1}, {"category_name": " "}]

    got = classify.discover_categories(df, suggest, batch=2).collect()
    assert [(r.category_name, r["count"], r.rationale, r.article_ids) for r in got] == [("환경/소음", 5, "r", [f"id{i}" for i in range(5)])]
    assert classify.discover_categories(df, suggest, least=6).count() == 0 and classify.discover_categories(df.drop("issue_category"), suggest).count() == 0
    assert classify.discover_categories(df, lambda lines: None).count() == 0


def test_headline():
    names = ("our_brands_relevant", "our_brands_negative", "our_brands_positive", "danger_high", "danger_medium", "competitor_articles", "total_result_count")
    got = reports.headline(dict.fromkeys(names, 2) | {"danger_high": None})
    assert got == "own brands: 2 negative, 2 positive; danger: 0 high, 2 medium; competitors: 2 articles; 2 in all"


def test_search_pages(spark):
    pages = {1: ["a", "b"], 3: ["b", "c"], 5: ["c", "b"], 7: ["a", "b"], 9: ["c", "a"], 11: ["new"]}
    asked = []

    def transport(query, start, size):
        asked.append(start)
        return 200, [{"link": x, "title": "t"} for x in pages.get(start, [])]

    assert [x["link"] for x in search.fetch_all(transport, "q", frozenset("a"), pages=9, size=2)] == ["b", "c"] and asked == [1, 3, 5, 7, 9]
    alone = lambda query, start, size: (200, [{"link": x, "title": "t"} for x in pages.get(start, [])])
    for known in (["a"], spark.createDataFrame([("a",), (None,)], "link string")):
        got = search.collect(spark, alone, known, ["q"], [], pages=9, size=2)
        assert sorted((r.link, r.query, r.group) for r in got.collect()) == [("b", "q", "자사"), ("c", "q", "자사")]
    spark.dataSource.register(search.search_source(alone, search.brands_of(["q"], ["r"]), pages=9, size=2))
    assert spark.read.format("newsloom_search").load().rdd.getNumPartitions() == 2
    with pytest.raises(RuntimeError):
        search.fetch_page(lambda *_: (429, []), "q", 1, 1)


def test_brands_are_saved_one_by_one(spark, tmp_path):
    """One brand fails and leaves the others as they are; a second time only new links are added."""

    def transport(query, start, size):
        if query == "bad" and start > 1:
            return 429, []
        return 200, [{"link": f"{query}{start + i}", "title": query} for i in range(size)] if start < 3 * size else []

    t = Table(spark, str(tmp_path / "raw"))
    counts, errors = search.collect_into(t, transport, ["one", "bad"], ["two"], at_once=2, size=2)
    assert set(errors) == {"bad"} and "429" in errors["bad"] and {k: v["added"] for k, v in counts.items()} == {"one": 6, "two": 6}
    assert sorted({(r.query, r.group) for r in t.read().collect()}) == [("one", "자사"), ("two", "경쟁사")]
    more = lambda query, start, size: (200, [{"link": f"{query}{start}"}, {"link": f"new {query}"}] if start == 1 else [])
    counts, errors = search.collect_into(t, more, ["one"], ["two"], size=2)
    assert not errors and {k: v["added"] for k, v in counts.items()} == {"one": 1, "two": 1} and t.read().count() == 14


def test_settings_say_what_is_collected(spark, tmp_path):
    from newsloom.config import load_settings

    (tmp_path / "own.json").write_text('{"our_brands": ["mine", "odd"], "competitors": []}')

    def transport(query, start, size):
        if query == "odd":
            return 503, []
        return 200, [{"link": f"{query}1", "title": "t"}] if start == 1 else []

    log = coverage.run(spark, str(tmp_path / "store"), "raw_only", settings=load_settings(str(tmp_path / "own.json")), transport=transport)
    assert log.metrics["articles_collected_per_query"] == {"mine": 1} and log.metrics["errors_total"] == 1
    assert [(r.link, r.query) for r in Table(spark, f"{tmp_path}/store/raw_data").read().collect()] == [("mine1", "mine")]
    assert Table(spark, f"{tmp_path}/store/errors").read().first().stage == "odd"


def test_replayed_batches_change_nothing(spark, tmp_path):
    """Blank keys are always added, so a batch that is run again would double them."""
    from newsloom.streaming.ingest import ingest

    schema = "link string, source string, at timestamp"
    rows = [("a", "x", "2026-02-01 10:00:00"), ("", "y", "2026-02-01 10:00:01"), ("a", "z", "2026-02-01 10:00:02")]
    spark.createDataFrame(rows, "link string, source string, at string").select("link", "source", F.to_timestamp("at").alias("at")).coalesce(1).write.parquet(str(tmp_path / "in"))
    t = Table(spark, str(tmp_path / "t"))
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in")).drop("at")
    ingest(read(), t, str(tmp_path / "check")).awaitTermination()
    before = sorted((r.link, r.source) for r in t.read().collect())
    assert before.count(("", "y")) == 1 and t.holds((str(tmp_path / "check"), 0)) and not t.holds((str(tmp_path / "check"), 1))
    for f in (tmp_path / "check" / "commits").iterdir():  # the batch's note is lost, as where the driver dies before it
        f.unlink()
    ingest(read(), t, str(tmp_path / "check")).awaitTermination()
    assert sorted((r.link, r.source) for r in t.read().collect()) == before
    once = Table(spark, str(tmp_path / "once"))
    keyed_ = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    ingest(keyed_, once, str(tmp_path / "check2"), prepare=lambda b: b.drop("at"), ts="at").awaitTermination()
    assert sorted(r.link for r in once.read().collect()) == ["", "a"]


def test_coverage_run_counts_failures_and_keeps_reasons(spark, tmp_path):
    answer = answering()
    first = lambda rows: [None if "fails" in r["title"] else answer(r, reasoning={"article_subject": r["title"]}) for r in rows]
    second = lambda rows: [answer(r, reasoning={"severity_analysis": "bad"}) for r in rows]
    rows = [("L7", "OUR", t, f"d{i} {t}", "Thu, 12 Feb 2026 10:00:00 +0900", "", f"https://www.a.com/{i}") for i, t in enumerate(["one thing", "another matter fails", "quite different"])]
    store = str(tmp_path / "store")
    log = coverage.run(spark, store, "full", classify.BatchClassifier(first, second), collected=spark.createDataFrame(rows, search.SCHEMA), chunk=2)
    m = log.metrics
    assert (m["articles_classified_llm"], m["classification_errors"], m["llm_api_calls"], m["pr_clusters_analyzed"], m["sv_clusters_verified"]) == (2, 1, 4, 0, 0)
    assert m["timestamp"] and m["llm_cost_estimated"] == round(2 * 0.000405, 4)
    result = {r.title: r for r in Table(spark, f"{store}/total_result").read().collect()}
    assert result["another matter fails"].classified_at == m["timestamp"] and result["another matter fails"].brand_relevance == "" and result["one thing"].danger_level == "중"
    reasons = {r.article_subject: r for r in Table(spark, f"{store}/reasoning").read().collect()}
    assert set(reasons) == {"one thing", "quite different"} and reasons["one thing"].severity_analysis == "bad" and reasons["one thing"].classified_at == m["timestamp"]


def test_coverage_run(spark, tmp_path):
    day = lambda n: f"Thu, {n:02d} Feb 2026 10:00:00 +0900"
    t = "<b>L7</b> hotel opens a new roof bar in gangnam"
    rows = [("L7", "OUR", t, "d one", day(12), "", f"https://www.a.com/{i}") for i in range(2)]
    rows += [("L7", "OUR", "L7 논란 stupid", "x", day(13), "", "https://b.com/1"), ("L7", "OUR", "too old", "x", "Thu, 01 Jan 2026 10:00:00 +0900", "", "https://b.com/2")]
    got = spark.createDataFrame(rows, search.SCHEMA)
    store = str(tmp_path / "store")
    log = coverage.run(spark, store, "full", now="2026-02-14T00:00:00", collected=got)
    result = {r.link: r for r in Table(spark, f"{store}/total_result").read().collect()}
    assert len(result) == 3 and log.metrics["articles_processed"] == 3 and log.metrics["our_brands_negative"] == 1
    assert result["https://www.a.com/0"].cluster_id == "L7_c00001" and result["https://www.a.com/0"].brand_relevance == "관련"
    assert result["https://b.com/1"].sentiment_stage == "부정 후보" and result["https://b.com/1"].danger_level == "중"
    assert result["https://b.com/1"].week_number == "2026-07" and result["https://b.com/1"].pub_datetime == "2026-02-13T10:00:00+09:00"
    again = coverage.run(spark, store, "recheck_only", now="later")
    assert again.metrics["reprocess_targets_total"] == 0
    assert Table(spark, f"{store}/run_history").read().count() == 2
    events = [r.stage for r in Table(spark, f"{store}/events").read().orderBy("stage").collect()]
    assert events == ["general_classification", "pr_classification", "processing", "source_verification"]
    assert coverage.run_mode(True, True) == "dry_run" and coverage.run_mode(recheck_only=True) == "recheck_only"
    assert load_settings().topics.jaccard_high == 0.5
