"""Keyword patterns with a marked anchor word, models and programs that annotate documents on the executors."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def phrase_mentions(df: DataFrame, words: str, patterns: list[tuple[str, str]]) -> DataFrame:
    """One row for each place of a pattern in an array of words: event_type, phrase_start, phrase_end, anchor (positions from 0).

    patterns: (event type, phrase); the anchor word stands in angle brackets and is the first word where none is marked.
    Words are compared without case. Rows without a match go.
    """
    low = F.transform(words, F.lower)

    def places(kind: str, phrase: str) -> Column:
        parts = phrase.lower().split(" ")
        anchor = next((i for i, p in enumerate(parts) if p.startswith("<") and p.endswith(">")), 0)
        plain = F.array(*[F.lit(p.replace("<", "").replace(">", "")) for p in parts])
        n = len(parts)
        found = F.filter(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.slice("_low", i + 1, n) == plain)
        starts = F.when(F.size(words) >= n, found).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(F.lit(kind).alias("event_type"), i.alias("phrase_start"), (i + n - 1).alias("phrase_end"), (i + anchor).alias("anchor")))

    hits = [places(*p) for p in patterns]
    return df.withColumn("_low", low).select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.concat(*hits)))


def annotate(docs: DataFrame, build: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """docs through a model that ``build`` loads once for each task; the model turns a batch of rows into rows of ``schema``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = build()
        for batch in batches:
            yield model(batch)

    return docs.mapInPandas(run, schema)


def pipe(docs: DataFrame, command: list[str], id_col: str = "doc_id", text_col: str = "text", timeout: int = 600) -> DataFrame:
    """(id_col, status int, output string): a program gets each text on its input. A null text counts as empty.

    A program that takes over ``timeout`` seconds is ended and has status -1, one that can't be started -2, both without output;
    neither ends the task.
    """

    def answer(text: str | None) -> tuple[int, str]:
        try:
            p = subprocess.run(command, input=(text or "").encode(), capture_output=True, timeout=timeout)
        except subprocess.TimeoutExpired:
            return -1, ""
        except OSError:
            return -2, ""
        return p.returncode, p.stdout.decode(errors="replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                status, output = answer(text)
                yield pa.RecordBatch.from_pydict({id_col: pa.array([i], b.schema.field(0).type), "status": pa.array([status], pa.int32()), "output": [output]})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, status INT, output STRING")
