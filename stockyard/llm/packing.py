"""Best-fit packing by large-item matching, over a histogram of lengths.

Lengths are whole numbers up to the capacity, so counts per length describe any corpus in at most ``capacity`` rows; only
these reach the driver. There whole runs of equal bins are filled at once:

1. Documents above a third of the capacity pair at most twice per bin: from the longest down, each takes the longest
   partner that fits.
2. Shorter ones, from the longest down, best-fit the smallest gap that holds them; a new bin opens when none does.

Each step either uses up a length or a run of bins, so the plan has a size bound of its own, whatever the input. It is
broadcast; every piece looks up its place by its rank among the pieces of its length. Ranks come from hash buckets of about
``NUMBERED`` pieces, so a length that a third of all pieces share is numbered in as many groups as it needs.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.llm import library_bpe
from stockyard.llm.bpe import vocabulary_path
from stockyard.llm.common import saved, text_of

CAPACITY = 2048
END = 0
NUMBERED = 50_000  # pieces of one length that are numbered in one group


class Plan:
    """Places for counts of lengths. ``runs[length]``: (first rank, first bin, per bin, offset), by first rank."""

    def __init__(self, counts: Mapping[int, int], capacity: int = CAPACITY):
        self.capacity, self.bins = capacity, 0
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self.used: dict[int, int] = {}
        self.gaps: list[tuple[int, int, int]] = []  # (gap, first bin, bins), sorted
        left = {k: v for k, v in counts.items() if v > 0}
        large = sorted(k for k in left if 3 * k > capacity)
        self._match(large, left)
        for size in sorted((k for k in left if 3 * k <= capacity), reverse=True):
            self._fill(size, left[size])

    def _take(self, size: int, count: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.runs.setdefault(size, []).append((self.used.get(size, 0), first_bin, per_bin, offset))
        self.used[size] = self.used.get(size, 0) + count

    def _open(self, count: int) -> int:
        self.bins += count
        return self.bins - count

    def _match(self, sizes: list[int], left: dict[int, int]) -> None:
        while sizes:
            size = sizes[-1]
            at = bisect_left(sizes, self.capacity - size + 1) - 1
            if at < 0:  # nothing large fits beside it
                count = left[size]
                self._take(size, count, first := self._open(count), 1, 0)
                self._gap(self.capacity - size, first, count)
                sizes.pop()
                continue
            mate = sizes[at]
            count = left[size] // 2 if mate == size else min(left[size], left[mate])
            if count:
                first = self._open(count)
                if mate == size:
                    self._take(size, 2 * count, first, 2, 0)
                else:
                    self._take(size, count, first, 1, 0)
                    self._take(mate, count, first, 1, size)
                self._gap(self.capacity - size - mate, first, count)
            left[size] -= count
            left[mate] -= count
            if mate == size:  # at most one is left of it
                if left[size]:
                    if at:  # it may still stand beside a smaller one
                        other = sizes[at - 1]
                        first = self._open(1)
                        self._take(size, 1, first, 1, 0)
                        self._take(other, 1, first, 1, size)
                        self._gap(self.capacity - size - other, first, 1)
                        left[other] -= 1
                        if not left[other]:
                            sizes.remove(other)
                    else:
                        self._take(size, 1, first := self._open(1), 1, 0)
                        self._gap(self.capacity - size, first, 1)
                sizes.pop()
            else:
                for used in (size, mate):
                    if not left[used]:
                        sizes.remove(used)

    def _gap(self, gap: int, first_bin: int, count: int) -> None:
        if gap and count:
            insort(self.gaps, (gap, first_bin, count))

    def _fill(self, size: int, count: int) -> None:
        while count:
            at = bisect_left(self.gaps, (size, -1, -1))
            if at == len(self.gaps):
                per = self.capacity // size
                fresh = -(-count // per)
                self._gap(self.capacity, self._open(fresh), fresh)
                continue
            gap, first, bins = self.gaps.pop(at)
            per = gap // size
            full = min(bins, count // per)
            offset = self.capacity - gap
            if full:
                self._take(size, full * per, first, per, offset)
                self._gap(gap - per * size, first, full)
                count -= full * per
            if full < bins and count:
                self._take(size, count, first + full, count, offset)
                self._gap(gap - count * size, first + full, 1)
                full, count = full + 1, 0
            self._gap(gap, first + full, bins - full)

    def lookup(self) -> dict[int, np.ndarray]:
        return {size: np.array(runs, dtype=np.int64) for size, runs in self.runs.items()}


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every row's tokens and end mark, cut only above the capacity."""
    path = path or vocabulary_path()
    end = END.to_bytes(4, "little")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = library_bpe.load(path)
        step = 4 * capacity
        for frame in frames:
            rows = []
            coded = (ids for texts in library_bpe.batches(frame["text"]) for ids in coder.encode_many(texts))
            for doc_id, ids in zip(frame["doc_id"].astype("Int64"), coded):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append((doc_id, at // step, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64", "piece": "int32"})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", text_of(docs).alias("text")).mapInPandas(run, schema)


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` of 1 to ``capacity``.

    Sequences are gapless from offset 0 and never above the capacity. Equal rows are items of their own. No rows give no
    rows.
    """
    spark = cut.sparkSession
    columns = cut.columns
    cut = saved(cut.withColumn("_row", F.monotonically_increasing_id()))  # rows of one id, or of none, spread over buckets too
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # capacity rows at most
    spread = [(length, -(-n // NUMBERED)) for length, n in histogram.items()]
    buckets = spark.createDataFrame(spread, "length long, _buckets long")
    dealt = cut.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.col("_buckets")))
    counts = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    runs = spark.sparkContext.broadcast(Plan(histogram, capacity).lookup())
    inside = W.partitionBy("length", "_bucket").orderBy("_row")
    ranked = (
        dealt.withColumn("_nth", F.row_number().over(inside))
        .join(offsets.select("length", "_bucket", "_before"), ["length", "_bucket"])
        .select(*columns, (F.col("_before") + F.col("_nth") - 1).alias("_rank"))
    )

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bins, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            ranks, lengths = frame["_rank"].to_numpy(), frame["length"].to_numpy()
            for size in np.unique(lengths):
                at = (lengths == size).nonzero()[0]
                run = runs.value[int(size)]
                own = run[np.searchsorted(run[:, 0], ranks[at], side="right") - 1]
                nth = ranks[at] - own[:, 0]
                bins[at] = own[:, 1] + nth // own[:, 2]
                offset[at] = own[:, 3] + nth % own[:, 2] * size
            yield frame.drop(columns="_rank").assign(sequence_id=bins, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields if f.name != "_row")
    return ranked.mapInPandas(place, f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every row of ``docs``, null and empty texts as their end mark.

    Repeated rows are packed each; only doc_id and text are read.
    """
    return packed(pieces(docs, path, capacity), capacity)
