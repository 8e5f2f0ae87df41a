"""Language identification with a string kernel.

Kernel: blended-spectrum presence, the shared distinct character n-grams (n = 1..3) of two texts over the root of
the product of their own counts. Landmarks for the Nystroem map and ridge rows are bounded samples for each
language, chosen by a hash of the row among all rows. Executors turn sampled texts into bit rows and sum the normal
equations of one-versus-rest kernel ridge regression; only landmarks' bits and those sums, whose size follows the
number of landmarks, reach the driver. As the decision is linear in n-gram presence, landmarks fold into one matrix,
and texts are scored by batched matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, tune

#: Hashed n-gram places, longest n-gram, texts in one matrix product.
PLACES = 1 << 14
LONGEST = 3
ROWS = 64
LANDMARKS_EACH = 100
SAMPLE_EACH = 800
#: Most landmarks of all languages together, and tasks that sum the normal equations.
LANDMARKS = 2000
SUMS = 8
RIDGE = 1e-2
#: Code points hashed at once; longer texts take several rounds into the same row.
PIECE = 1 << 18


def presence(text: str, row: np.ndarray, places: int = PLACES) -> None:
    """Set row[g] = 1 for each distinct n-gram of the whole lower-cased text."""
    low = text.lower()
    for at in range(0, max(1, len(low)), PIECE):
        c = np.frombuffer(low[max(0, at - LONGEST + 1) : at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
        h = np.zeros(len(c), np.uint32)
        for n in range(LONGEST):
            h = (h[: len(c) - n] + c[n:] + np.uint32(1)) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            row[(h * np.uint32(0x85EBCA77)) >> np.uint32(32 - places.bit_length() + 1)] = 1


def rows_of(texts: list[str]) -> np.ndarray:
    """One presence row for each text, scaled so that a dot product is the kernel."""
    x = np.zeros((len(texts), PLACES), np.float32)
    for i, t in enumerate(texts):
        presence(t or "", x[i])
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, rank, presence row as bits) of (lang, rank, text)."""
    for b in batches:
        bits = []
        for t in b.column(2).to_pylist():
            row = np.zeros(PLACES, np.uint8)
            presence(t, row)
            bits.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bits, pa.binary())], names=["lang", "rank", "bits"])


def unpacked(bits: list[bytes]) -> np.ndarray:
    """Presence rows, scaled so that a dot product is the kernel."""
    x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def nystroem(marks: np.ndarray) -> np.ndarray:
    """The matrix that turns kernel values with the landmarks into features whose dot products are the kernel."""
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-8 * max(values.max(initial=0), 1e-12)
    return vectors[:, good] / np.sqrt(values[good])


def normal_equations(langs: list[str], x: np.ndarray, marks: np.ndarray, root: np.ndarray, names: list[str], weight: dict[str, float]):
    """(sum of w phi phi', sum of w phi y') over rows x; y is 1 for a row's own language, -1 for the others."""
    phi = (x @ marks.T).astype(np.float64) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None], 1.0, -1.0)
    w = phi * np.array([weight[k] for k in langs])[:, None]
    return w.T @ phi, w.T @ y


def _sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, root, names, weight = shared.value
        marks, a, b = unpacked(bits), 0.0, 0.0
        for batch in batches:
            langs, own = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(own), 4 * ROWS):
                da, db = normal_equations(langs[i : i + 4 * ROWS], unpacked(own[i : i + 4 * ROWS]), marks, root, names, weight)
                a, b = a + da, b + db
        if not np.isscalar(a):
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], names=["a", "b"])

    return run


def fit(sample: DataFrame, landmarks_each: int) -> tuple[list[str], np.ndarray]:
    """Languages, and the matrix that presence rows are multiplied with, from (lang, rank, bits)."""
    spark = sample.sparkSession
    counts = dict(tuple(r) for r in sample.groupBy("lang").agg(F.count(F.lit(1))).orderBy("lang").collect())
    names, n = list(counts), sum(counts.values())
    if not names:
        return [], np.zeros((PLACES, 0), np.float32)
    each = max(1, min(landmarks_each, LANDMARKS // len(names)))
    bits = [bytes(r[0]) for r in sample.where(F.col("rank") <= each).orderBy("lang", "rank", "bits").select("bits").collect()]
    marks = unpacked(bits)
    root = nystroem(marks)
    weight = {k: n / (len(names) * c) for k, c in counts.items()}  # languages count alike
    shared = spark.sparkContext.broadcast((bits, root, names, weight))
    sums = sample.select("lang", "bits").repartition(SUMS).mapInArrow(_sums(shared), "a binary, b binary").collect()
    d = root.shape[1]
    a = sum(np.frombuffer(r[0]).reshape(d, d) for r in sums)
    b = sum(np.frombuffer(r[1]).reshape(d, len(names)) for r in sums)
    beta = np.linalg.solve(a + RIDGE * n * np.eye(d) / 100, b)
    return names, (marks.T.astype(np.float64) @ (root @ beta)).astype(np.float32)


def _letters(text: str) -> bool:
    return any(map(str.isalpha, text))


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, w = model.value
        for b in batches:
            texts = b.column(2).to_pylist()
            lang, score = [], []
            for i in range(0, len(texts), ROWS):
                own = texts[i : i + ROWS]
                out = rows_of(own) @ w if names else np.zeros((len(own), 0), np.float32)
                for t, margin in zip(own, out, strict=True):
                    if not names or not t or not _letters(t):
                        lang.append("und")
                        score.append(0.0)
                        continue
                    e = np.exp(4.0 * (margin.astype(np.float64) - margin.max()))
                    k = int(margin.argmax())
                    lang.append(names[k])
                    score.append(float(e[k] / e.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def bounded_sample(rows: DataFrame, group: str, key: str, each: int) -> DataFrame:
    """At most ``each`` rows of every value of ``group``, by least hash of ``key``; groups are not gathered.

    Counts come first; a threshold on the hash keeps about 2 * each rows of a group before they are ranked.
    """
    h = F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1 << 40))
    counts = rows.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * each + 40) / F.col("_n"))
    few = rows.join(F.broadcast(counts), F.col(group) == F.col("_g")).where(h < share * F.lit(float(1 << 40)))
    w = Window.partitionBy(group).orderBy(h, key)
    return few.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= each).drop("_g", "_n")


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_each: int = SAMPLE_EACH, landmarks_each: int = LANDMARKS_EACH,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every whole text.

    Learns from text and non-null lang of rows whose crc32(doc_id as text) mod 3 is not 1 (held_out: it is), at
    most ``sample_each`` of a language. Null texts and texts without a letter are ``und`` with score 0, as is
    every text where nothing can be learned. Rows with null doc_id are not held out and not learned from. The
    number of languages is taken to be small; all together have at most LANDMARKS landmarks. Equal margins go to the
    language that comes first in order; repeated rows are scored alike; texts of any length are read whole. Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    tune(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    part = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(part == 1, F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
    )
    learn = rows.where("not held_out and doc_id is not null and lang is not null and text is not null")
    ids = bounded_sample(learn.select("doc_id", "lang"), "lang", "doc_id", sample_each).select("doc_id", "_rank")
    ids = ids.groupBy("doc_id").agg(F.min("_rank").alias("_rank"))
    sample = learn.join(F.broadcast(ids), "doc_id").select("lang", F.col("_rank").cast("int").alias("rank"), "text")
    sample = materialise(sample.mapInArrow(_bits, "lang string, rank int, bits binary"), "sample")
    model = fit(sample, landmarks_each)
    shared = spark.sparkContext.broadcast(model)
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
