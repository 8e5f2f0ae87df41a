"""Quality classification by positive-unlabelled learning.

Trusted positives are rows labelled good; everything without a label is unlabelled web text. The class prior is
estimated over all unlabelled rows (but for those that trained its ranker), and a small network over surface features
minimises the non-negative unbiased risk  pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)) on bounded samples. Labels of bad
quality are never used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, tune

POSITIVES = 6000
UNLABELLED = 12000
THRESHOLD = 0.3
HIDDEN = 16

_CLASSES = [b"*", b"&", b"%", b"$", b"#", b"|", b"!", b"?", b".,;:", b"\"'()-", b"@/\\_=+<>{}[]^~`", b"0123456789", b"\n"]
_TABLE = np.zeros((256, len(_CLASSES) + 3))
for _j, _c in enumerate(_CLASSES):
    _TABLE[list(_c), _j] = 1
_TABLE[65:91, len(_CLASSES)] = 1
_TABLE[97:123, len(_CLASSES) + 1] = 1
_TABLE[128:, len(_CLASSES) + 2] = 1


def features(text: bytes) -> np.ndarray:
    """Surface features of a whole text, each of about unit size."""
    data = np.frombuffer(text, np.uint8)
    n = max(1, len(data))
    counts = np.bincount(data, minlength=256) @ _TABLE
    words = text.split()
    k = max(1, len(words))
    kinds = len(set(words)) / k
    low = text.lower().split()
    twice = sum(map(bytes.__eq__, low, low[1:])) / k
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, k - 1) if k > 1 else 1.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines) if lines else 0.0
    upper, lower = counts[len(_CLASSES)], counts[len(_CLASSES) + 1]
    return np.concatenate(
        (
            np.log1p(20 * counts[: len(_CLASSES)] / k),
            [upper / max(1.0, upper + lower), counts[-1] / n, kinds, pairs, repeated, np.log1p(k) / 8,
             min(3.0, len(text) / k / 8), kinds * np.log1p(k) / 8, np.log1p(len(lines) / k * 20), np.log1p(20 * twice)],
        )
    )


def _forward(x, w1, b1, w2, b2):
    h = np.tanh(x @ w1 + b1)
    return h, h @ w2 + b2


def prior_cuts(p: np.ndarray) -> np.ndarray:
    return np.quantile(p, np.linspace(0.02, 0.98, 97))


def class_prior(p: np.ndarray, tails: np.ndarray, total: int) -> float:
    """Share of positives among the unlabelled: least ratio of the tails of a score over the unlabelled and over p.

    tails: how many of ``total`` unlabelled scores reach each of ``prior_cuts(p)``. Each tail ratio bounds the share
    from above as soon as the score ranks well; the added terms keep small tails from winning by chance.
    """
    cuts = prior_cuts(p)
    slack = np.sqrt(np.log(40) / 2 / len(p)) + np.sqrt(np.log(40) / 2 / total)
    qp, qu = np.array([(p >= c).mean() for c in cuts]), tails / total
    best = int(np.argmin((qu + slack) / qp))
    return float(np.clip(qu[best] / qp[best], 0.02, 0.98))


def risk_gradient(z: np.ndarray, k: int, prior: float | None) -> np.ndarray:
    """Gradient by z of the non-negative risk; the first k outputs are positives. None: plain p against u.

    With the logistic loss the plus side's derivative is s - 1, the minus side's s. Where the unbiased negative part
    R_u(-) - prior * R_p(-) is below zero, the step goes back on that part alone.
    """
    s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    g = np.zeros(len(z))
    if prior is None:
        g[:k], g[k:] = (s[:k] - 1) / k, s[k:] / (len(z) - k)
        return g
    minus = np.logaddexp(0, z)
    if minus[k:].mean() - prior * minus[:k].mean() >= 0:
        g[:k], g[k:] = prior * (s[:k] - 1) / k - prior * s[:k] / k, s[k:] / (len(z) - k)
    else:
        g[:k], g[k:] = prior * s[:k] / k, -s[k:] / (len(z) - k)
    return g


def _train(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, seed: int = 0):
    """Adam on the logistic loss; prior None: plain p against u, to rank for the prior's estimate."""
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    par = [rng.normal(0, 0.5 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(x) for x in par], [np.zeros_like(x) for x in par]
    x = np.concatenate((p, u))
    k = len(p)
    for t in range(1, steps + 1):
        h, z = _forward(x, *par)
        g = risk_gradient(z, k, prior)
        back = np.outer(g, par[2]) * (1 - h * h)
        grads = [x.T @ back + 1e-4 * par[0], back.sum(0), h.T @ g + 1e-4 * par[2], g.sum()]
        for i, gr in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * gr
            v[i] = 0.999 * v[i] + 0.001 * gr * gr
            par[i] = par[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return par


def _scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def fit(p: np.ndarray, u: np.ndarray, tails_of):
    """(mean, scale, network, prior), or None if there is nothing to learn from.

    tails_of: (mean, scale, ranker, cuts) -> (tails, total) over unlabelled rows outside the first half of u.
    """
    if len(p) < 20 or len(u) < 20:
        return None
    both = np.concatenate((p, u))
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = _scaled(p, mean, scale), _scaled(u, mean, scale)
    half_p = len(p) // 2
    ranker = _train(p[:half_p], u[: len(u) // 2], None, 200)
    ranked = _forward(p[half_p:], *ranker)[1]
    prior = class_prior(ranked, *tails_of(mean, scale, ranker, prior_cuts(ranked)))
    return mean, scale, _train(p, u, prior, 500), prior


def score_features(x: np.ndarray, model) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    mean, scale, par, _ = model
    z = _forward(_scaled(x, mean, scale), *par)[1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t or b"").tolist() for t in byte_rows(b.column(3))]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(x, pa.list_(pa.float64()))], names=["positive", "doc_id", "hash", "x"])


def _bins(shared):
    """(doc_id, bin): how many of the cuts a row's score by the ranker reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, scale, ranker, cuts = shared.value
        for b in batches:
            x = np.array([features(t or b"") for t in byte_rows(b.column(1))]).reshape(b.num_rows, -1)
            z = _forward(_scaled(x, mean, scale), *ranker)[1] if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.searchsorted(cuts, z, "right").astype(np.int32))], names=["doc_id", "bin"])

    return run


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t or b"") for t in byte_rows(b.column(2))]
            s = score_features(np.array(x), model.value) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s, pa.float64())], names=["doc_id", "held_out", "score"]
            )

    return run


def _least_hashed(ids: DataFrame, n: int) -> list:
    """The ``n`` ids of least hash. Tasks send their top-n to the driver, so only hashes below a cut, under which about
    2n + 1000 ids lie, take part: what is sent doesn't grow with the tasks. Too few below it, by repeated ids: a higher cut.
    """
    at = F.xxhash64(F.lit(11), "doc_id")
    share = (2 * n + 1000) / max(1, ids.count())
    while True:
        some = ids if share >= 1 else ids.where(at < int(-(2**63) + share * 2**64))
        found = [r[0] for r in some.distinct().orderBy(at, "doc_id").limit(n).collect()]
        if len(found) == n or share >= 1:
            return found
        share *= 8


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
):
    """Model from at most ``positives`` rows labelled 1 and ``unlabelled`` rows without a label.

    Labels count only where crc32(doc_id as text) mod 5 is not 0. Where every row has a label, the unlabelled
    sample is drawn from all rows of that part, their labels unseen. Of a repeated id the least text is learned from.
    """
    spark = docs.sparkSession
    tune(spark)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    known = labels.select(F.col("doc_id"), "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    good = _least_hashed(known.where(learn & (F.col("quality") == 1)).select("doc_id"), positives)
    every = docs.select(F.col(id_col).alias("doc_id")).where(F.col("doc_id").isNotNull())
    free = _least_hashed(every.where(learn).join(known, "doc_id", "left_anti"), unlabelled)
    rest = free
    unlabelled_left = bool(rest)
    rest = rest or _least_hashed(every.where(learn), unlabelled)
    rows = [(k, True) for k in good] + [(k, False) for k in rest]
    if not rows:
        return None
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = spark.createDataFrame(rows, f"doc_id {kind}, positive boolean")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    # one text an id, however often it is repeated: the samples' bounds hold for what reaches the driver
    texts = texts.groupBy("positive", "doc_id").agg(F.min("text").alias("text"))
    got = texts.select("positive", "doc_id", F.xxhash64(F.lit(13), "doc_id").alias("hash"), "text")
    got = got.mapInArrow(_features, f"positive boolean, doc_id {kind}, hash bigint, x array<double>")
    p, u, free_ids = [], [], []
    # halves of the samples are halves by hash, not by id; sorted here, as a sort in Spark would sample its keys to the driver
    for r in sorted(got.collect(), key=lambda r: (r[2], r[1])):
        (p if r[0] else u).append(r[3])
        if not r[0]:
            free_ids.append(r[1])

    def tails_of(mean, scale, ranker, cuts):
        shared = spark.sparkContext.broadcast((mean, scale, ranker, cuts))
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull() & learn)
        bins = rows.mapInArrow(_bins(shared), f"doc_id {kind}, bin int")
        if unlabelled_left:
            bins = bins.join(known.select("doc_id").distinct(), "doc_id", "left_anti")
        used = spark.createDataFrame([(k,) for k in dict.fromkeys(free_ids[: len(free_ids) // 2])], f"doc_id {kind}")
        bins = bins.join(F.broadcast(used), "doc_id", "left_anti")
        counts = np.zeros(len(cuts) + 1, np.int64)
        for k, n in bins.groupBy("bin").agg(F.count(F.lit(1))).collect():
            counts[k] = n
        reach = counts[::-1].cumsum()[::-1]
        return reach[1:], max(1, int(reach[0]))

    return fit(np.array(p), np.array(u), tails_of)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **sizes
) -> DataFrame:
    """doc_id, held_out (crc32(doc_id as text) mod 5 is 0), score (0 to 1) and predicted of every whole text.

    Null and empty texts are scored as texts without words. Null ids are not held out and not learned from.
    Repeated rows are scored alike. Without enough labels every score is 0.5. Other columns are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels, id_col, text_col, **sizes))
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_scores(model), f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _passing(model, threshold: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t or b"") for t in byte_rows(b.column(at))]
            if x:
                yield b.filter(pa.array(score_features(np.array(x), model.value) >= threshold))

    return run


def keep_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **sizes
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score reaches ``threshold``; their texts aren't shuffled.

    Null and empty texts are scored as texts without words; repeated rows share their fate; rows with a null id are
    scored like others. Without enough labels every row stays. An empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train_quality(docs, labels, id_col, text_col, **sizes))
    return docs.mapInArrow(_passing(model, threshold, docs.columns.index(text_col)), docs.schema)
