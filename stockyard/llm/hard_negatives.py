"""Hard-negative mining by secondary sort.

The score of an anchor and a row is an exact integer inner product. Anchors and rows meet in blocks, so that every pair is
scored without a row for it. What a block lets through is chosen twice, each time without loss: first the best positives
of each anchor among its rows, then, the positives being known, for each of them the best negatives inside its window. A
surviving pair is one packed key (anchor, descending score, positives first, id); ``repartitionAndSortWithinPartitions``
brings an anchor's keys together in order, and an iterator walks them: a positive opens its window, a negative goes to every
open window with room. It remembers the open windows of one anchor, never its keys.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved, streamed_groups

ANCHOR_EVERY, LABEL_EVERY, LABELS = 100, 7, 10
SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative scores between this share (in percent) of its positive's score and the whole of it.
LEAST, MOST = 80, 100
ANCHORS_A_BLOCK, ROWS_A_BLOCK = 512, 2048
_KEY = struct.Struct(">QQBQ")
_SIGN = 1 << 63
_TOP = (1 << 64) - 1


def key_of(anchor: int, score: int, negative: bool, row: int) -> bytes:
    """Bytes that sort by anchor, falling score, positives before negatives, id."""
    return _KEY.pack(anchor + _SIGN, _TOP - (score + _SIGN), negative, row + _SIGN)


def parts_of(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, row = _KEY.unpack(key)
    return anchor - _SIGN, _TOP - score - _SIGN, bool(negative), row - _SIGN


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, parts: whole-number components of the rows that take part, one row for each id."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label = F.when(F.col("vec_id") % LABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select("vec_id", F.struct(label.cast("long").alias("label"), whole.alias("parts")).alias("least"))
    return rows.groupBy("vec_id").agg(F.min("least").alias("least")).select("vec_id", "least.*")


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), dtype=np.int64)
    largest = [max(int(side.max()), -int(side.min())) for side in (anchors, rows)]
    reach = largest[0] * largest[1] * anchors.shape[1]
    if reach < 1 << 53:  # every partial sum is a whole number that a double holds
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    if reach < 1 << 63:
        return anchors @ rows.T
    exact = anchors.astype(object) @ rows.astype(object).T
    if max(map(abs, exact.ravel())) >= 1 << 63:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


def _matrix(parts: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector's missing components count as zero."""
    out = np.zeros((len(parts), width), dtype=np.int64)
    for i, row in enumerate(parts):
        out[i, : len(row)] = row
    return out


def _first(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Positions of each anchor's first ``keep`` pairs by falling score, then id."""
    order = np.lexsort((ids, -score, anchor))
    inner = anchor[order]
    starts = np.flatnonzero(np.r_[True, inner[1:] != inner[:-1]]) if len(inner) else np.zeros(0, dtype=np.int64)
    nth = np.arange(len(inner)) - np.repeat(starts, np.diff(np.r_[starts, len(inner)]))
    return order[nth < keep]


def _blocks(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors, as (a, b, side, vec_id, label, parts, windows).

    Block sizes do not grow with the data; ``a`` and ``b`` together are the key, so no label or id is hot.
    """
    n_rows, n_anchors = rows.count(), anchors.count()
    to_rows, to_anchors = max(1, -(-n_rows // ROWS_A_BLOCK)), max(1, -(-n_anchors // ANCHORS_A_BLOCK))

    def dealt(df: DataFrame, side: int, own: str, other: str, own_n: int, other_n: int, windows: Column) -> DataFrame:
        home = F.pmod(F.xxhash64("vec_id"), F.lit(own_n)).alias(own)
        return df.select(
            home, F.explode(F.expr(f"sequence(0L, {other_n - 1}L)")).alias(other),
            F.lit(side).alias("side"), "vec_id", "label", "parts", windows.alias("windows"),
        )

    windows = F.col("windows") if "windows" in anchors.columns else F.lit(None).cast("array<long>")
    left = dealt(anchors, 0, "a", "b", to_anchors, to_rows, windows)
    right = dealt(rows, 1, "b", "a", to_rows, to_anchors, F.lit(None).cast("array<long>"))
    both = left.unionByName(right)
    tasks = min(to_rows * to_anchors, 64 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(tasks, "a", "b").sortWithinPartitions("a", "b", "side", "vec_id")


def _scored(frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
    """(anchors, rows, products, same label, same row) of each meeting of two blocks."""
    for group in streamed_groups(frames, ["a", "b"]):
        side = group["side"].to_numpy()
        anchors, rows = group[side == 0], group[side == 1]
        if len(anchors) and len(rows):
            width = int(group["parts"].map(len).max())
            score = products(_matrix(anchors["parts"], width), _matrix(rows["parts"], width))
            same = anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[None]
            itself = anchors["vec_id"].to_numpy()[:, None] == rows["vec_id"].to_numpy()[None]
            yield anchors, rows["vec_id"].to_numpy(), score, same, itself


def _keys(anchors: pd.DataFrame, ids: np.ndarray, score: np.ndarray, at: np.ndarray, of: np.ndarray, negative: bool) -> pd.DataFrame:
    names = anchors["vec_id"].to_numpy()
    keys = [key_of(int(names[i]), int(score[i, j]), negative, int(ids[j])) for i, j in zip(at, of)]
    return pd.DataFrame({"key": keys})


def positive_keys(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES) -> DataFrame:
    """Keys of each block's best positives of every anchor."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for owners, ids, score, same, itself in _scored(frames):
            at, of = np.nonzero(same & ~itself)
            first = _first(at, score[at, of], ids[of], positives)
            yield _keys(owners, ids, score, at[first], of[first], False)

    return _blocks(rows, anchors).mapInPandas(run, "key binary")


def negative_keys(rows: DataFrame, anchors: DataFrame, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Keys of each block's best negatives in every window of every anchor (``windows``: the positives' scores)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for owners, ids, score, same, _ in _scored(frames):
            chosen = np.zeros(score.shape, dtype=bool)
            windows = owners["windows"].tolist()
            for nth in range(max(map(len, windows))):
                tops = [int(w[nth]) if nth < len(w) else None for w in windows]
                # 100 * score between LEAST and MOST times the positive's score, in whole numbers
                low = np.array([1 if t is None else -(-least * t // 100) for t in tops], dtype=np.int64)[:, None]
                high = np.array([0 if t is None else most * t // 100 for t in tops], dtype=np.int64)[:, None]
                at, of = np.nonzero((score >= low) & (score <= high) & ~same)
                first = _first(at, score[at, of], ids[of], negatives)
                chosen[at[first], of[first]] = True
            at, of = np.nonzero(chosen)
            yield _keys(owners, ids, score, at, of, True)

    return _blocks(rows, anchors).mapInPandas(run, "key binary")


def _in_order(keys: DataFrame) -> RDD:
    """The keys, an anchor's in one partition and all in order."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = keys.rdd.map(lambda row: (bytes(row[0]), None))
    return pairs.repartitionAndSortWithinPartitions(n, lambda key: zlib.crc32(key[:8])).keys()


def best_positives(keys: Iterable[bytes], positives: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, score, id) of each anchor's first keys."""
    now, seen = None, 0
    for key in keys:
        anchor, score, _, row = parts_of(key)
        if anchor != now:
            now, seen = anchor, 0
        if seen < positives:
            seen += 1
            yield anchor, score, row


def negatives_in_windows(keys: Iterable[bytes], negatives: int, least: int, most: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive's score, negative's score), from one walk over sorted keys.

    A window that is not open yet lies wholly below the negatives passed so far if ``most`` is 100 or less.
    """
    now, windows = None, []
    for key in keys:
        anchor, score, negative, row = parts_of(key)
        if anchor != now:
            now, windows = anchor, []
        if not negative:
            windows.append([row, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and least * w[1] <= 100 * score]  # scores fall: others are over
        for window in windows:
            if 100 * score <= most * window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], row, window[1], score


def mined(
    vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
    anchor_every: int = ANCHOR_EVERY,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``anchor_every`` divides. Rows without an id, label or vector, or with a component that is
    null or not finite, take no part; of rows with one id the least (label, components) does. A shorter vector's
    missing components count as zero. Equal scores come by id. An anchor without positives, and a positive without
    negatives in its window, give no rows; neither does an empty table. A window holds scores between ``least`` and ``most``
    percent of its positive's score: none if that is negative. Other columns are not read. A product beyond 64 bits is
    an OverflowError.
    """
    if most > 100:
        raise ValueError("a window ends at its positive's score: most is 100 percent at the most")
    spark = vectors.sparkSession
    rows = saved(usable(vectors))
    anchors = rows.filter(F.col("vec_id") % anchor_every == 0)
    best = _in_order(saved(positive_keys(rows, anchors, positives)))
    schema = "vec_id long, score long, positive_id long"
    chosen = saved(spark.createDataFrame(best.mapPartitions(lambda keys: best_positives(keys, positives)), schema, verifySchema=False))
    scores = chosen.groupBy("vec_id").agg(F.sort_array(F.collect_set("score"), False).alias("windows"))  # ``positives`` at most
    found = negative_keys(rows, anchors.join(scores, "vec_id"), negatives, least, most)
    opening = chosen.rdd.map(lambda row: (key_of(row[0], row[1], False, row[2]),))
    keys = found.unionAll(spark.createDataFrame(opening, "key binary", verifySchema=False))
    walked = _in_order(saved(keys)).mapPartitions(lambda part: negatives_in_windows(part, negatives, least, most))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return saved(spark.createDataFrame(walked, schema, verifySchema=False))


#: The definition in DuckDB's SQL, over the view ``embeddings``.
ORACLE = f"""
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % {LABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_dot_product(a.parts, o.parts)::BIGINT AS score
  FROM part a JOIN part o ON a.vec_id <> o.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
mined AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS nth
  FROM positive p JOIN pair n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND {LEAST} * p.positive_score <= 100 * n.score AND 100 * n.score <= {MOST} * p.positive_score)
SELECT anchor_id, positive_id, nth::INTEGER AS rank, negative_id, positive_score, negative_score
FROM mined WHERE nth <= {NEGATIVES}
"""
