"""Blocked similarity joins: TF-IDF character n-gram cosine and token Jaccard.

A pair can only reach a threshold if it shares one of the few features that both rank first, so candidates come
from those alone (prefix filtering): features are ordered rarest first, and a row's prefix ends where the rest of
its vector is too short (cosine) or too small (Jaccard) to reach the threshold without it. Common n-grams thus
never meet in the candidate join. Candidates are then scored exactly on all their features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import idf
from ..functions.text import char_grams
from ..storage import materialise
from .cells import set_scores

#: Rows of a block in one cell of the grid.
CELL = 128
#: Rows of the largest block that a grid may have: it compares all pairs.
GRID_ROWS = 8192
#: Pairs that cells compare in the time that a candidate takes to be written and scored.
SET_PRODUCTS = 50


def gram_weights(df: DataFrame, block: str, row: str, text: str, least_df: int = 1) -> DataFrame:
    """(block, row, gram, df, w): L2-normalised TF-IDF weights, fitted on each block; grams as 64-bit hashes.

    A row counts for its block's n even if it has no gram; grams in fewer than ``least_df`` rows are dropped first.
    """
    rows = df.select(F.col(block).alias("block"), F.col(row).alias("row"), F.col(text).alias("text"))
    n = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    # texts move once, before they become many grams: counting a row's grams then needs no further exchange
    rows = rows.repartition(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))), "block", "row")
    tf = rows.select("block", "row", F.explode(char_grams(F.col("text"))).alias("gram")).select("block", "row", F.xxhash64("gram").alias("gram")).groupBy("block", "row", "gram").agg(F.count(F.lit(1)).alias("tf"))
    df_ = tf.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least_df)
    w = tf.join(df_, ["block", "gram"]).join(F.broadcast(n), "block").withColumn("w", F.col("tf") * idf(F.col("n"), F.col("df")))
    own = Window.partitionBy("block", "row")
    return w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(own))).select("block", "row", "gram", "df", "w")


def _candidates(prefix: DataFrame) -> DataFrame:
    a = prefix.select("block", F.col("gram"), F.col("row").alias("i"))
    b = prefix.select("block", F.col("gram"), F.col("row").alias("j"))
    return a.join(b, ["block", "gram"]).where("i < j").select("block", "i", "j").distinct()


def cosine_pairs(weights: DataFrame, least: float, strategy: str = "auto") -> DataFrame:
    """(block, i, j, cosine) of every pair in a block with cosine >= least > 0, i < j; both strategies are exact.

    prefix: candidates from rare grams, see ``_prefix_pairs``; best where texts share few grams. grid: all pairs of a
    block in cells of about 2 * CELL rows, by matrix products; best where a block's texts share most grams. auto
    counts what the prefix join would make and takes the cheaper; a grid only where no block has over GRID_ROWS rows.
    """
    rest = materialise(_with_rest(weights), "weights")
    if strategy == "auto":
        prefix = rest.where(F.col("rest") >= least / 2).groupBy("block", "gram").agg(F.count(F.lit(1)).alias("n"))
        made = prefix.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
        rows = rest.select("block", "row").distinct().groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        pairs, largest = rows.agg(F.sum(F.col("n") * F.col("n")), F.max("n")).first()
        strategy = "prefix" if made < 2 * (pairs or 0) or (largest or 0) > GRID_ROWS else "grid"
    return _prefix_pairs(rest, least) if strategy == "prefix" else _grid_pairs(rest, least)


def _with_rest(weights: DataFrame) -> DataFrame:
    """rest: the norm of a row's gram and all its more common ones."""
    own = Window.partitionBy("block", "row").orderBy("df", "gram").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return weights.withColumn("rest", F.sqrt(F.sum(F.col("w") * F.col("w")).over(own)))


def _prefix_pairs(rest: DataFrame, least: float) -> DataFrame:
    """A prefix goes on until the rest of the vector is shorter than half the threshold.

    What two rows share outside their prefixes adds at most the longer of their rests, so the dot product over
    shared prefix grams already drops nearly all pairs; only the others are scored on all grams.
    """
    row = Window.partitionBy("block", "row")
    prefix = rest.where(F.col("rest") >= least / 2)
    prefix = prefix.withColumn("end", F.sqrt(F.greatest(F.lit(0.0), 1 - F.sum(F.col("w") * F.col("w")).over(row))))
    a = prefix.select("block", "gram", F.col("row").alias("i"), F.col("w").alias("x"), F.col("end").alias("ex"))
    b = prefix.select("block", "gram", F.col("row").alias("j"), F.col("w").alias("y"), F.col("end").alias("ey"))
    shared = a.join(b, ["block", "gram"]).where("i < j").groupBy("block", "i", "j")
    shared = shared.agg(F.sum(F.col("x") * F.col("y")).alias("part"), F.max(F.greatest("ex", "ey")).alias("end"))
    found = shared.where(F.col("part") + F.col("end") >= least - 1e-6).select("block", "i", "j")
    a = rest.select("block", "gram", F.col("row").alias("i"), F.col("w").alias("x"))
    b = rest.select("block", "gram", F.col("row").alias("j"), F.col("w").alias("y"))
    scored = found.join(a, ["block", "i"]).join(b, ["block", "j", "gram"]).groupBy("block", "i", "j")
    return scored.agg(F.round(F.sum(F.col("x") * F.col("y")), 9).alias("cosine")).where(F.col("cosine") >= least)


def _grid_pairs(rest: DataFrame, least: float) -> DataFrame:
    """Rows of a block are dealt into cells by hash; each pair of cells is one group of bounded size."""
    vectors = rest.groupBy("block", "row").agg(F.collect_list(F.struct("gram", "w")).alias("v"))
    cells = rest.select("block", "row").distinct().groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    rows = vectors.join(cells, "block").select(
        "block", "row", F.col("v.gram").alias("gram"), F.col("v.w").alias("w"), F.pmod(F.xxhash64("row"), F.col("cells")).cast("int").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other"),
    )
    rows = rows.withColumns({"low": F.least("cell", "other"), "high": F.greatest("cell", "other")}).drop("other")
    types = {f.name: f.dataType.simpleString() for f in rest.schema}
    schema = f"block {types['block']}, i {types['row']}, j {types['row']}, cosine double"
    return rows.groupBy("block", "low", "high").applyInArrow(_cell_scores(least), schema)


def _cell_scores(least: float):
    def run(t):
        import numpy as np
        import pyarrow as pa

        t = t.combine_chunks()
        size = np.array([len(x) for x in t["gram"]], np.int64)
        who = np.repeat(np.arange(len(size)), size)
        flat = lambda c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        _, gram, n = np.unique(flat("gram"), return_inverse=True, return_counts=True)
        shared = n >= 2
        place = np.cumsum(shared) - 1
        keep = shared[gram]
        x = np.zeros((len(size), int(shared.sum())))
        x[who[keep], place[gram[keep]]] = flat("w")[keep]
        low, high, cell, row = (t[c].to_numpy() for c in ("low", "high", "cell", "row"))
        left = np.flatnonzero(cell == low)
        right = np.flatnonzero(cell == high)
        score = np.round(x[left] @ x[right].T, 9)
        a, b = np.nonzero(score >= least)
        i, j = row[left[a]], row[right[b]]
        if len(low) and low[0] == high[0]:
            good = i < j
        else:
            good = np.ones(len(i), bool)
        i, j, s = i[good], j[good], score[a, b][good]
        block = t["block"].combine_chunks().take(pa.array(np.zeros(len(i), np.int64)))
        return pa.Table.from_arrays([block, pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(s, pa.float64())], names=["block", "i", "j", "cosine"])

    return run


def jaccard_pairs(df: DataFrame, block: str, row: str, tokens: str, least: float, strategy: str = "auto") -> DataFrame:
    """(block, i, j, jaccard) of every pair in a block with jaccard >= least > 0, i < j; tokens: distinct.

    prefix: candidates from rare tokens, written and scored; cells: all pairs of a block, nothing written but packed sets
    (``cells.set_scores``). auto takes cells unless the candidates are few beside all pairs. Both are exact.
    """
    rows = df.select(F.col(block).alias("block"), F.col(row).alias("row"), F.col(tokens).alias("t")).where(F.size("t") > 0)
    rows = materialise(rows.where(F.col("block").isNotNull()), "sets")
    flat = rows.select("block", "row", F.size("t").alias("n"), F.explode("t").alias("gram"))
    df_ = flat.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("df"))
    w = Window.partitionBy("block", "row").orderBy("df", "gram")
    ranked = flat.join(df_, ["block", "gram"]).withColumn("p", F.row_number().over(w))
    # without one of its first n - ceil(least * n) + 1 tokens a row shares too few
    prefix = ranked.where(F.col("p") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    if strategy == "auto":
        shared = prefix.groupBy("block", "gram").agg(F.count(F.lit(1)).alias("n"))
        made = shared.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0
        pairs = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * F.col("n") / 2)).first()[0] or 0
        strategy = "prefix" if SET_PRODUCTS * made < pairs else "cells"
    if strategy == "cells":
        return set_scores(rows, "t", least).withColumnRenamed("jac0", "jaccard")
    found = _candidates(prefix)
    a, b = (rows.select("block", F.col("row").alias(k), F.col("t").alias(f"t{k}")) for k in ("i", "j"))
    both = found.join(a, ["block", "i"]).join(b, ["block", "j"])
    score = F.size(F.array_intersect("ti", "tj")) / F.size(F.array_union("ti", "tj"))
    return both.select("block", "i", "j", F.round(score, 9).alias("jaccard")).where(F.col("jaccard") >= least)
