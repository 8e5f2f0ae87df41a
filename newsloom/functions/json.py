"""JSON expressions and the lenient repair of model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUMMARY = "array<struct<cluster_id:string,summary:string>>"


def response_text(payload: Column) -> Column:
    """The answer's text: output_text, else the first text of any output's contents, else of any choice's message."""
    x = F.from_json(payload, "output_text string, output array<struct<content:array<struct<text:string>>>>, choices array<struct<message:struct<content:string>>>")
    given = lambda texts: F.get(F.filter(texts, lambda t: t.isNotNull() & (t != "")), F.lit(0))
    contents = F.flatten(F.transform(F.filter(x["output"], lambda o: o["content"].isNotNull()), lambda o: F.transform(o["content"], lambda c: c["text"])))
    messages = F.transform(x["choices"], lambda c: c["message"]["content"])
    return F.coalesce(F.nullif(x["output_text"], F.lit("")), given(contents), given(messages))


def repair(text: Column) -> Column:
    """Without code fences and back quotes, from the first brace to the last, commas before a closing bracket dropped."""
    x = F.replace(F.regexp_replace(text, r"```(?:json)?\s*", ""), F.lit("`"), F.lit(""))
    inner = F.regexp_extract(x, r"(?s)\{.*\}", 0)
    bare = F.trim(x)
    pick = F.when(bare.startswith("["), F.regexp_extract(bare, r"(?s)\[.*\]", 0)).when(inner != "", inner).otherwise(x)
    return F.regexp_replace(F.trim(pick), r",\s*([\]}])", "$1")


def summaries(text: Column) -> Column:
    """The list of (cluster_id, summary) in an answer, an object's or a bare list; null where there is none."""
    x = repair(text)
    inside = F.from_json(x, f"summaries {SUMMARY}")["summaries"]
    return F.when(x.startswith("["), F.from_json(x, SUMMARY)).otherwise(inside)


def decode(c: Column, schema: str) -> Column:
    """A JSON object's fields as a struct; null where it doesn't parse."""
    return F.from_json(c, schema)


def encode_list(c: Column) -> Column:
    return F.to_json(c)
