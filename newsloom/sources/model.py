"""A language model asked from executors: prompts in, answers' payloads out, with a bound on calls at once and a rate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import repair, response_text
from .retry import Refused, with_retries

#: prompt -> (HTTP status, seconds of its Retry-After header or None, JSON text); raises OSError where the network fails.
Post = Callable[[str], tuple[int, float | None, str]]
CALLED = "payload string, status string, error string, calls int"


def render_column(template: str, values: dict[str, Column]) -> Column:
    """``{{name}}`` places of a template filled in for each row, null as empty; unknown names stay."""
    out: Column = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{{" + k + "}}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def call_model(
    rows: DataFrame, prompt: str, post: Post, workers: int = 3, per_second: float | None = None, attempts: int = 5,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``rows`` with payload, status (ok, failed), error and calls of each one's ``prompt``, a string column.

    At most ``workers`` calls run at once, one in each of as many partitions, and each waits so that all together start at
    most ``per_second`` calls a second. Refusals and errors that stay fail their own row only. The answer isn't
    deterministic: write the result before it is used twice.
    """
    pause = workers / per_second if per_second else 0.0
    names = [*rows.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for f in frames:
            out = []
            for text in f[prompt]:
                said: list[str] = []
                calls = 0

                def send(text=text):
                    nonlocal calls, last
                    if last is not None and pause:
                        sleep(max(0.0, last + pause - time.monotonic()))
                    last, calls = time.monotonic(), calls + 1
                    return post(text)

                try:
                    payload = with_retries(send, attempts, sleep, notify=said.append)
                    out.append((payload, "ok" if payload is not None else "failed", None if payload is not None else "; ".join(said[-1:]), calls))
                except Refused as error:
                    out.append((None, "failed", f"{type(error).__name__}: {error}", calls))
                except Exception as error:  # whatever the transport answers: this row alone fails
                    out.append((None, "failed", f"{type(error).__name__}: {error}"[:500], calls))
            more = pd.DataFrame(out, columns=["payload", "status", "error", "calls"], index=f.index).astype({"calls": "int32"})
            yield pd.concat([f[names], more], axis=1)

    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema)
    return rows.repartition(workers).mapInPandas(run, f"{schema}, {CALLED}")


def answers(called: DataFrame, schema: str) -> DataFrame:
    """``called`` with the answer's JSON as the struct ``answer``; an answer that can't be read, even repaired, has failed."""
    # a text that doesn't parse gives a struct of nulls, so what didn't is asked for by name
    whole = F.from_json(repair(response_text(F.col("payload"))), f"{schema}, _unread string", {"columnNameOfCorruptRecord": "_unread"})
    found = F.when(whole["_unread"].isNull(), whole)
    bad = (F.col("status") == "ok") & F.col("answer").isNull()
    read = called.withColumn("answer", F.when(F.col("status") == "ok", found))
    return read.withColumns({"error": F.when(bad, "unreadable answer").otherwise(F.col("error")), "status": F.when(bad, "failed").otherwise(F.col("status"))}).drop("payload")
