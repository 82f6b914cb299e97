"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.session import shared_folder

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a compressed table in the shared checkpoint folder and read it from there.

    Lost executors then cost a read, not the work again, and row values never change between uses.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(df: DataFrame) -> Column:
    """The text, null counted as empty."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def with_row(docs: DataFrame, **extra: Column) -> DataFrame:
    """``row`` (all columns of ``docs``), ``doc_id`` and ``extra``: whatever ``docs`` calls its columns, nothing clashes."""
    return docs.select(F.expr("struct(*)").alias("row"), F.col("doc_id"), *[c.alias(n) for n, c in extra.items()])


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, hash of the text) is not in ``dropped`` (doc_id, text_hash)."""
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    rows = with_row(docs, text_hash=F.xxhash64(text_of(docs)))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    return rows.join(gone, same, "left_anti").select("row.*")


def streamed_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, across the batches of a sorted partition; one group is held at a time."""
    held: list[pd.DataFrame] = []
    held_key = None
    for frame in frames:
        if not len(frame):
            continue
        values = frame[keys]
        change = values.ne(values.shift()).any(axis=1).to_numpy()
        change[0] = True
        starts = [*change.nonzero()[0], len(frame)]
        for a, b in zip(starts, starts[1:]):
            key = tuple(values.iloc[a])
            if held and key != held_key:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(frame.iloc[a:b])
            held_key = key
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
