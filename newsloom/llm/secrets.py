"""Secret scans over an incremental blob ledger.

Every historical version of every path is content-addressed by the SHA-256 of its text. The ledger holds
the (blob, rule version) pairs scanned so far and what they gave; only unseen pairs are scanned, each blob
once whatever the number of its paths, and findings are joined back to all paths by digest.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import exists, temporary
from .common import materialise, tune

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _assign(text: str) -> list[tuple[int, int]]:
    low = text.lower()
    if not any(w in low for w in _WORDS):
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]


def _access(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16] if "AKIA" in text else []


def _hex(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _HEX.finditer(text)]


def _pem(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PEM.finditer(text)] if "-----BEGIN " in text else []


def _jwt(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _JWT.finditer(text)] if "eyJ" in text else []


#: (kind, version, function): a rule's version changes whenever what it finds does. The first three are base kinds.
RULES: tuple[tuple[str, str, Callable[[str], list[tuple[int, int]]]], ...] = (
    ("assign", "1", _assign),
    ("access", "1", _access),
    ("hex", "1", _hex),
    ("pem", "1", _pem),
    ("jwt", "1", _jwt),
)
BASE = ("assign", "access", "hex")
SPANS = "array<struct<begin:int,end:int>>"


def _scanner(kinds: tuple[str, ...]):
    rules = [r for r in RULES if r[0] in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, kind, version, spans = [], [], [], []
            texts, wanted = b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, (text, todo) in enumerate(zip(texts, wanted, strict=True)):
                for k, v, find in rules:
                    if k in todo:
                        rows.append(i)
                        kind.append(k)
                        version.append(v)
                        spans.append([{"begin": x, "end": y} for x, y in find(text or "")])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(rows, pa.int64())), pa.array(kind, pa.string()), pa.array(version, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
                ],
                names=["blob", "kind", "version", "spans"],
            )

    return run


LEDGER = f"blob string, kind string, version string, spans {SPANS}"


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an empty one where there is none yet."""
    return spark.read.schema(LEDGER).parquet(path) if exists(spark, path) else spark.createDataFrame([], LEDGER)


def unseen_pairs(blobs: DataFrame, ledger: DataFrame) -> DataFrame:
    """The blobs (blob, ...) with ``todo``, the kinds whose (blob, rule version) pair the ledger lacks; others drop out.

    Only the ledger's keys of these blobs are gathered: a small batch is broadcast to the ledger's scan.
    """
    known = ledger.select("blob", "kind", "version").join(blobs.select("blob"), "blob", "left_semi")
    seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
    now = F.array(*[F.lit(f"{k}:{v}") for k, v, _ in RULES])
    todo = F.array_except(now, F.coalesce("seen", F.array().cast("array<string>")))
    out = blobs.join(seen, "blob", "left").withColumn("todo", F.transform(todo, lambda x: F.split_part(x, F.lit(":"), F.lit(1))))
    return out.where(F.size("todo") > 0).drop("seen")


def scan_secrets(
    versions: DataFrame, path_col: str = "doc_id", text_col: str = "text", ledger: str | None = None
) -> DataFrame:
    """path, blob (hex SHA-256 of the text) and findings (kind, begin, end by begin, then rule order) of each version.

    ledger: folder of the Parquet ledger (blob, kind, version, spans), which grows by the pairs this call scans, clean
    ones included; None starts one below ``spark.checkpoint.dir`` that goes when the session ends. Spans are code
    points, end exclusive. Null text counts as empty. Repeated rows give repeated results; paths may be null; a table
    without rows gives none; texts of any length are scanned whole. Columns other than the two named are not looked at.
    """
    spark = versions.sparkSession
    tune(spark)
    ledger = ledger or temporary(spark, "ledger")
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    addressed = rows.withColumn("blob", F.sha2("text", 256))
    paths = materialise(addressed.select("path", "blob"), "paths")
    kinds = [k for k, _, _ in RULES]
    blobs = paths.groupBy("blob").agg(F.min(F.struct("path")).alias("holder"))
    todo = unseen_pairs(blobs, _ledger(spark, ledger))
    chosen = todo.select(F.col("blob").alias("_blob"), F.col("holder.path").alias("_path"), "todo")
    unseen = addressed.join(
        chosen, addressed["path"].eqNullSafe(chosen["_path"]) & (addressed["blob"] == chosen["_blob"])
    ).select("blob", "text", "todo")
    # a version may be listed twice under one path: the pair is written for each, and read as one
    unseen.mapInArrow(_scanner(tuple(kinds)), LEDGER).write.mode("append").parquet(ledger)
    current = F.create_map(*[F.lit(x) for k, v, _ in RULES for x in (k, v)])
    known = _ledger(spark, ledger).where(F.col("version") == current[F.col("kind")])
    place = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    per_blob = (
        known.where(F.size("spans") > 0)
        .dropDuplicates(["blob", "kind", "version"])
        .select("blob", F.explode("spans").alias("s"), "kind")
        .groupBy("blob")
        .agg(
            F.array_sort(
                F.collect_list(F.struct(F.col("s.begin").alias("begin"), place[F.col("kind")].alias("place"), F.col("s.end").alias("end"), "kind"))
            ).alias("findings")
        )
    )
    return paths.join(per_blob, "blob", "left").select(
        "path", "blob",
        F.transform(
            F.coalesce("findings", F.array().cast("array<struct<begin:int,place:int,end:int,kind:string>>")),
            lambda x: F.struct(x["kind"].alias("kind"), x["begin"].alias("begin"), x["end"].alias("end")),
        ).alias("findings"),
    )


def span_text(findings):
    """kind:begin:end of the findings, comma-joined."""
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])), ",")
