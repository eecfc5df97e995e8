"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import scratch_path
from quayside.sinks.lake_write import delete_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared checkpoint folder, so that a lost executor
    re-reads files instead of recomputing what led to them. ``drop`` deletes
    those that no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{step}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def again(self, kept: DataFrame) -> DataFrame:
        """A kept table once more, for a join with itself."""
        return self.spark.read.schema(kept.schema).parquet(kept._scratch)

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            if path := getattr(f, "_scratch", None):
                delete_path(self.spark, path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed: ``pick(df, id="doc_id", text="text")``.
    Extra columns, whatever their names, can't clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`").alias(a) for a, c in columns.items()])


#: Bytes of text that are worked on at a time in a task (a longer text alone).
SLICE_BYTES = 1 << 20


def slices(b: pa.RecordBatch, text_at: int | None) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``SLICE_BYTES`` of its text column."""
    if text_at is None:
        yield b
        return
    size = pc.fill_null(pc.binary_length(b.column(text_at)), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(size, dtype=np.int64), 0
    while first < b.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - size[first] + SLICE_BYTES, side="right")))
        yield b.slice(first, last - first)
        first = last


def per_batch(df: DataFrame, work: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
              schema: T.StructType, text_at: int | None = None) -> DataFrame:
    """``mapInArrow`` with per-task state: ``work()`` runs once in each task and
    returns what is applied to every Arrow batch, cut by the size of the text column
    at ``text_at`` so that a task's memory doesn't grow with the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for whole in batches:
            for b in slices(whole, text_at):
                if b.num_rows:
                    step = step or work()
                    yield step(b)

    return df.mapInArrow(run, schema)


def text_key(text: Column) -> Column:
    """128 bits of the text; a null text counts as an empty one."""
    return F.md5(F.coalesce(text, F.lit("")))


def doc_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the decimal id, modulo ``mod``: the folds of the labelled rows.
    A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod
