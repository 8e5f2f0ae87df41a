import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from newsloom.llm import langid, quality, queries, secrets


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_quality_classifier(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / max(1, len(bad)) < 0.35


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 3.0), (2, "", 1.0), (None, "a b", None), (2, "", 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == 4 and {r.score for r in got} == {0.5}
    assert quality.keep_quality(docs, labels).schema == docs.schema
    assert quality.keep_quality(docs, labels).count() == 4
    assert quality.score_quality(docs.limit(0), labels.limit(0)).count() == 0


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    p, u = rng.normal(3, 1, 4000), np.concatenate((rng.normal(3, 1, 3500), rng.normal(-3, 1, 1500)))
    tails = np.array([(u >= c).sum() for c in quality.prior_cuts(p)])
    assert abs(quality.class_prior(p, tails, len(u)) - 0.7) < 0.06


def test_gradient_of_the_non_negative_risk():
    """Against differences of the risk; where the negative part is below zero, against minus that part."""
    rng = np.random.default_rng(3)
    loss = lambda z, y: np.logaddexp(0, -y * z)
    seen = set()
    for shift, prior in ((0.0, 0.3), (0.0, 0.6), (3.0, 0.9), (4.0, 0.95)):
        k, z = 30, np.concatenate((rng.normal(shift, 1, 30), rng.normal(0, 1, 50)))
        negative = lambda z: loss(z[k:], -1).mean() - prior * loss(z[:k], -1).mean()
        whole = lambda z: prior * loss(z[:k], 1).mean() + negative(z)
        back = negative(z) < 0
        seen.add(bool(back))
        f = (lambda z: -negative(z)) if back else whole
        g = quality.risk_gradient(z, k, prior)
        for i in range(len(z)):
            up, down = z.copy(), z.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            assert abs((f(up) - f(down)) / 2e-5 - g[i]) < 1e-7
    assert seen == {True, False}


def test_folded_language_matrix_is_kernel_ridge(spark):
    """Decisions by the folded matrix against ridge on an explicit kernel matrix of sets."""
    texts = [(f"the house and {i} dogs run", "en") for i in range(12)] + [(f"das haus und {i} hunde laufen", "de") for i in range(12)] + [(f"la maison et {i} chiens", "fr") for i in range(9)]
    df = spark.createDataFrame([(k, i, t) for i, (t, k) in enumerate(texts)], "lang string, rank int, text string").mapInArrow(langid._bits, "lang string, rank int, bits binary")
    names, w = langid.fit(df, 100)
    rows = [np.zeros(langid.PLACES, np.float32) for _ in texts]
    for r, (t, _) in zip(rows, texts):
        langid.presence(t, r)
    sets = [set(np.flatnonzero(r).tolist()) for r in rows]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    y = np.where(np.array([k for _, k in texts])[:, None] == np.array(names)[None], 1.0, -1.0)
    weight = np.array([len(texts) / (len(names) * sum(k == own for _, k in texts)) for _, own in texts])
    lam = langid.RIDGE * len(texts) / 100
    alpha = np.linalg.solve(kernel + lam * np.diag(1 / weight), y)  # all rows are landmarks: the map is exact
    x = np.stack(rows)
    got = (x / np.sqrt(x.sum(1, keepdims=True))) @ w
    assert names == ["de", "en", "fr"] and np.abs(got - kernel @ alpha).max() < 1e-3


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = queries.op9_language_id(spark, sf).join(docs, "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() / held.count() > 0.98
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_edge_rows(spark):
    base = [(i, t, k) for i in range(60) for t, k in ((f"the house and {i} dogs", "en"), (f"das haus und {i} hunde", "de"))]
    rows = [(i, t, k, 1) for i, (_, t, k) in enumerate(base)]
    rows += [(900, None, "en", 1), (901, "", None, 1), (902, "12 34", "de", 1), (None, "das haus", "de", 1), (903, "das haus " * 200_000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in langid.identify_languages(docs).collect()}
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert got[None].lang_pred == got[903].lang_pred == "de" and not got[None].held_out
    assert langid.identify_languages(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bounded_sample_is_bounded_and_even(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), F.when(F.col("id") < 4900, "a").otherwise("b").alias("g"))
    got = {r.g: r["count"] for r in langid.bounded_sample(rows, "g", "k", 50).groupBy("g").count().collect()}
    assert got == {"a": 50, "b": 50}


TEXTS = [
    "Password: 'hunter22hunter' and token=short", None, "", "API_KEY=abcdefgh.ijk x AKIAABCDEFGHIJKL1 AKIA12",
    "é deadbeefdeadbeefdeadbeefdeadbeef00 secret : secret: abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "tokentoken = = x", "paſſword=abcdefghi",
]


def brute(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = []
    for k, (kind, p) in enumerate((("assign", assign), ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+")))):
        for m in p.finditer(text or ""):
            if (k == 0 and len(m[2]) >= 8) or (k == 1 and len(m[0]) >= 16) or (k == 2 and len(m[0]) >= 32):
                found.append((m.start(), k, m.end(), kind))
    return ",".join(f"{b}:{a}:{c}" for a, _, c, b in sorted(found))


def test_secret_query_equals_plain_patterns(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op5_secret_scan(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(brute(docs[r.doc_id]).encode()).hexdigest()


def test_ledger_scans_only_unseen_pairs(spark, tmp_path, monkeypatch):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "y"), (1, TEXTS[0], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob string")
    at = str(tmp_path / "ledger")
    first = secrets.scan_secrets(docs, ledger=at).collect()
    assert sorted(map(str, first)) == sorted(map(str, secrets.scan_secrets(docs).collect()))
    by = {r.path: secrets_text(r) for r in first if r.path is not None and r.path > 1}
    for k, t in enumerate(TEXTS):
        if k > 1:
            assert ",".join(x for x in by[k].split(",") if not x.startswith(("pem", "jwt"))) == brute(t)
    n = spark.read.parquet(at).count()
    assert n == len({t or "" for t in TEXTS}) * len(secrets.RULES)
    secrets.scan_secrets(docs, ledger=at).collect()
    assert spark.read.parquet(at).count() == n
    more = docs.unionByName(spark.createDataFrame([(77, "token=abcdefghij", "")], docs.schema))
    secrets.scan_secrets(more, ledger=at).collect()
    assert spark.read.parquet(at).count() == n + len(secrets.RULES)
    monkeypatch.setattr(secrets, "RULES", (*secrets.RULES[:4], ("jwt", "2", secrets._jwt)))
    again = secrets.scan_secrets(docs, ledger=at).collect()
    assert spark.read.parquet(at).count() == n + len(secrets.RULES) + len({t or "" for t in TEXTS})
    assert sorted(map(str, again)) == sorted(map(str, first))
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def secrets_text(r):
    return ",".join(f"{x.kind}:{x.begin}:{x.end}" for x in r.findings)


def test_quality_samples_are_bounded_with_repeated_ids(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u, tails: seen.append((len(p), len(u))))
    docs = spark.createDataFrame([(i, f"t{i} {k}" if k else None) for i in range(20) for k in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, quality int")
    quality.train_quality(docs, labels, positives=2, unlabelled=3)
    assert seen == [(2, 3)]


def test_least_hashed_ids_are_the_first_by_hash(spark):
    ids = spark.range(40000).selectExpr("id % 9000 AS doc_id").unionByName(spark.range(20000).selectExpr("5L AS doc_id"))
    want = [r[0] for r in ids.distinct().orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(700).collect()]
    assert quality._least_hashed(ids, 700) == want
    assert quality._least_hashed(ids.where("doc_id < 9"), 700) == quality._least_hashed(ids.where("doc_id < 9"), 9)
    assert quality._least_hashed(ids.where("doc_id < 0"), 7) == []
