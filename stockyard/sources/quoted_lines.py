"""Records of text files whose quoted fields may hold line breaks, read by as many tasks as the files have blocks.

A line break ends a record if the quotes before it are even in number. Each block is read twice: once to count its quotes,
whose prefix sums over the blocks of a file tell whether a block begins inside quotes, and once to put its lines together.
Records inside a block are complete; the pieces of those that cross its edges, two for a block at most, are joined
afterwards. The texts themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.session import materialize

_BLOCK = ["file", "block"]
#: What a row of the second pass is.
WHOLE, OPENS, GOES_ON = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with the file and the block they were read from; a block's lines come in order."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _inside(lines: DataFrame) -> tuple[DataFrame, int]:
    """Whether each block begins inside quotes (a row for each block), and in how many files quotes stay open."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    counted = lines.groupBy(*_BLOCK).agg(F.sum(quotes).alias("quotes"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)  # a row per block
    inside = counted.select(*_BLOCK, (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    open_files = counted.groupBy("file").agg(F.sum("quotes").alias("quotes")).filter("quotes % 2 = 1")
    return inside, open_files.count()


def _pieces(inside: dict[tuple[str, int], bool]):
    """Put the lines of a task's blocks together."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, within, kind, nth = None, [], False, WHOLE, 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal held, nth
            if held:
                out.append((*now, nth, kind, "\n".join(held)))
                held, nth = [], nth + 1

        for frame in frames:
            for value, file, block in zip(frame["value"], frame["file"], frame["block"]):
                if (file, block) != now:
                    if now and held:  # the record at the block's end goes on in the next one
                        kind = OPENS if kind == WHOLE else kind
                    close()
                    now, nth, within = (file, block), 0, inside[(file, block)]
                    kind = GOES_ON if within else WHOLE
                held.append(value)
                if value.count('"') % 2:
                    within = not within
                if not within:
                    close()
                    kind = WHOLE
            yield pd.DataFrame(out, columns=["file", "block", "nth", "kind", "record"])
            out = []
        if held:
            kind = OPENS if kind == WHOLE else kind
            close()
            yield pd.DataFrame(out, columns=["file", "block", "nth", "kind", "record"])

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """record: every record of the files at ``path`` behind their common header line, with its line breaks.

    Quotes inside fields are doubled, and fields that hold a quote or a line break are quoted; lines end with LF or CRLF. A
    file whose quotes stay open is an error, and so is a file with another header. Blank lines outside quotes are no records.
    """
    lines = _lines(spark, path)
    inside, open_files = _inside(lines)
    if open_files:
        raise ValueError(f"{path}: quotes stay open in {open_files} files")
    known = {(r["file"], r["block"]): r["inside"] for r in inside.collect()}  # a row for each block that is read
    pieces = lines.mapInPandas(_pieces(known), "file string, block long, nth long, kind int, record string")
    edges = materialize(pieces.filter(F.col("kind") != WHOLE))
    order = W.partitionBy("file").orderBy("block", "nth")  # two pieces of a block at most
    chained = edges.withColumn("chain", F.sum((F.col("kind") == OPENS).cast("int")).over(order))
    joined = chained.groupBy("file", "chain").agg(
        F.min(F.struct("block", "nth")).alias("at"), F.array_sort(F.collect_list(F.struct("block", "nth", "record"))).alias("parts")
    )
    crossing = joined.select("at.block", "at.nth", F.array_join("parts.record", "\n").alias("record"))
    both = pieces.filter(F.col("kind") == WHOLE).select("block", "nth", "record").unionByName(crossing)
    both = both.select((F.col("block") + F.col("nth") == 0).alias("first"), F.rtrim("record", F.lit("\r")).alias("record"))
    head = lines.select("value").first()
    header = F.rtrim(F.lit(head["value"] if head else None), F.lit("\r"))
    other = F.raise_error(F.concat(F.lit(f"{path}: files have different headers: "), "record"))
    kept = F.when(~F.col("first"), F.trim("record") != "").when(F.col("record") == header, False).otherwise(other.cast("boolean"))
    return both.filter(kept).select("record")
