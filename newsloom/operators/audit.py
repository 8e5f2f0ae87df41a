"""Completeness audit: which rows must be processed again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import AUDIT_FIELDS
from ..functions.text import clean_invisible, is_blank


def field_flags(result: DataFrame, fields: Sequence[str] = tuple(AUDIT_FIELDS), key: str = "link") -> DataFrame:
    """(link, missing_<field> ...) of every result row with a key; an absent column is missing everywhere."""
    flags = [(is_blank(F.col(f)) if f in result.columns else F.lit(True)).alias(f"missing_{f}") for f in fields]
    return result.select(clean_invisible(F.col(key)).alias(key), *flags).where(F.col(key) != "")


def reprocess_targets(raw: DataFrame, result: DataFrame | None, fields: Sequence[str] = tuple(AUDIT_FIELDS), key: str = "link") -> DataFrame:
    """Raw rows whose key has no result, or a result with any field blank; without results all of them."""
    if result is None:
        return raw
    flags = field_flags(result, fields, key)
    whole = flags.groupBy(key).agg(F.bool_and(~F.greatest(*[F.col(f"missing_{f}") for f in fields])).alias("_ok"))
    done = whole.where("_ok").select(F.col(key).alias("_done"))
    return raw.join(done, clean_invisible(raw[key]) == done["_done"], "left_anti")


def missing_counts(result: DataFrame, fields: Sequence[str] = tuple(AUDIT_FIELDS), key: str = "link") -> DataFrame:
    """(field, missing): result rows in which the field is blank."""
    flags = field_flags(result, fields, key)
    one = flags.agg(*[F.count_if(f"missing_{f}").alias(f) for f in fields])
    return one.unpivot([], list(fields), "field", "missing")


def analysis_status(result: DataFrame, fields: Sequence[str] = tuple(AUDIT_FIELDS), key: str = "link") -> DataFrame:
    """(link, missing): every key, and whether any of its rows lacks a field."""
    flags = field_flags(result, fields, key)
    return flags.groupBy(key).agg(F.bool_or(F.greatest(*[F.col(f"missing_{f}") for f in fields])).alias("missing"))
