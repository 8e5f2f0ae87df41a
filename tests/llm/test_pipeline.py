import numpy as np
import pytest
from pyspark.sql import functions as F

from test_decontaminate import plain_score
from test_near_dedup import brute

from newsloom.llm import decontaminate as D


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    import corpus_pipeline as P
    from newsloom.llm.common import materialise

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in P.STAGES:
        after = materialise(stage(spark, docs, sf_dir), name)
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_order(spark, sf_dir, stages):
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert [n for n, _, _ in stages] == ["quality_classifier", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == names
        assert set(ids(after)) <= set(ids(before))


def test_each_stage_against_brute_force(spark, sf_dir, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    by = {n: (b, a) for n, b, a in stages}
    before, after = by["quality_classifier"]
    kept = set(ids(after))
    good = [k for k in ids(before) if labels.get(k) == 1]
    assert sum(k in kept for k in good) > 0.95 * len(good)

    before, after = by["exact_dedup"]
    best = {}
    for r in before.collect():
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        best[t] = max(best.get(t, -1), r.doc_id)
    assert ids(after) == sorted(best.values())

    before, after = by["near_dedup"]
    want = brute([(r.doc_id, r.text) for r in before.collect()], 5)
    assert ids(after) == sorted(k for k, _, _, keep in want if keep)

    before, after = by["decontamination"]
    items = [D.words(r.text).tolist() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = set(ids(after))
    for r in before.collect():
        if r.doc_id not in left:
            own = D.words(r.text)
            assert max(plain_score(i, own.tolist()) - 0.6 * len(i) for i in items) >= -1e-9
    before, after = by["packing"]
    assert sorted({r.doc_id for r in after.select("doc_id").collect()}) == ids(before)
    total = after.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in total) <= 2048


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, stages):
    import corpus_pipeline as P

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = P.run(spark, sf_dir).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1][2].select(*cols).collect()))
    assert len(got) > 0 and np.all([r.length > 0 for r in got])


def test_stages_of_odd_tables(spark, sf_dir):
    """Nulls, empty and blank texts, repeated rows, null ids, an extra column with a clashing name; then no rows."""
    import corpus_pipeline as P
    from newsloom.llm.common import materialise

    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, text_key string"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, "ONE two"), (None, "null id text"), (None, None), (6, "a b c d e f g h"), (7, "A b c d e f g h")]
    docs = spark.createDataFrame([(k, t, None, None, None, "k", "t") for k, t in rows], schema)
    want = (["2", "3", "5", "7", "None"], [], ["7"])  # of null texts the largest id
    for table, left in zip((docs, docs.limit(0), docs.withColumn("text", F.lit(None).cast("string"))), want, strict=True):
        for name, stage in P.STAGES:
            table = materialise(stage(spark, table, sf_dir), name)
            if name != "packing":
                assert table.columns == docs.columns
            if name == "exact_dedup":
                assert sorted(str(r.doc_id) for r in table.collect()) == left
        assert table.count() == 0 if not left else table.count() > 0
