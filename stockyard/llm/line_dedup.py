"""Substring dedup by paragraph hashing.

A *paragraph* is any ``PARAGRAPH`` words in a row, wherever they stand. Paragraphs are normalised (lower case, blanks
collapsed) and hashed. Two passes find the repeated ones without a row for every word:

1. *Anchors* are the paragraphs whose digest is the least of any ``MARKED - PARAGRAPH + 1`` neighbours. The choice depends on
   nothing else, so a repeated passage of ``MARKED`` words brings an anchor with it and anchors in it overlap. Digests are
   grouped globally by a min aggregate, which combines before the shuffle.
2. A repeated anchor whose neighbour in its text is not repeated stands near a passage's end. There all paragraphs are
   hashed, in all its occurrences, and grouped once more, so passages are found to their true ends.

The occurrence with the smallest (doc_id, hash of the text, position) stays: texts are told apart by both, as an id can be
null or clash. All others are marked, marks that touch are joined, and joined marks of at least ``MARKED`` words are
removed, with their offsets in the original text retained.

A passage held by a third of all documents is one partial row per task in the grouping, and the join back has two stored
sides, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.llm.common import saved, text_of, with_row
from stockyard.llm.shingles import WordHashes, words_of

#: Passages of over 50 words are to be found; joined marks are removed from so many words on.
MARKED = 40
#: Words of a hashed paragraph.
PARAGRAPH = 25
_LAST = 2**63 - 1
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    out = np.ones((2, size), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for row, base in zip(out, (_BASE, _BACK)):
            row[1:] = np.multiply.accumulate(np.full(size - 1, base, dtype=np.uint64))
    return out[0], out[1]


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, and where each word starts and ends."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inner = np.zeros(len(codes) + 2, dtype=np.int8)
    inner[1:-1] = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    edge = np.diff(inner)
    return codes, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def paragraphs(text: str, known: WordHashes, least: int = PARAGRAPH) -> tuple[np.ndarray, ...]:
    """Digest, first word, start and end offset of every paragraph."""
    hashes = known.of(words_of(text.lower()))
    n = len(hashes)
    if n < least:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    codes, starts, ends = word_spans(text)
    a = np.arange(n - least + 1)
    power, inverse = _powers(1 << max(16, int(n).bit_length()))
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(hashes * power[:n])])
    digest = (sums[a + least] - sums[a]) * inverse[a]
    digest = (digest ^ (digest >> np.uint64(32)) ^ np.uint64(least)) * np.uint64(_BASE)
    return digest.astype(np.int64), a, starts[a], ends[a + least - 1]


def picked(digest: np.ndarray, width: int) -> np.ndarray:
    """The places of the first least value of any ``width`` in a row."""
    if len(digest) <= width:
        return np.array([np.argmin(digest)] if len(digest) else [], dtype=np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(digest, width)
    return np.unique(rows.argmin(axis=1) + np.arange(len(rows)))


def _hashed(docs: DataFrame) -> DataFrame:
    text = text_of(docs)
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _found(frame: pd.DataFrame, found: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    """Rows of ``units`` from each text's digest, first word, start, end and gaps."""
    digest, lo, start, stop, gaps = (np.concatenate([f[k] for f in found]) for k in range(5))
    ids = frame[["doc_id", "text_hash"]].astype({"doc_id": "Int64"})
    owner = ids.iloc[np.repeat(np.arange(len(found)), [len(f[0]) for f in found])].reset_index(drop=True)
    return pd.concat([owner, pd.DataFrame({"digest": digest, "place": lo << 32 | start, "size": gaps << 32 | stop - start})], axis=1)


_UNITS = "doc_id long, text_hash long, digest long, place long, size long"


def units(docs: DataFrame, least: int = PARAGRAPH, width: int = MARKED - PARAGRAPH + 1) -> DataFrame:
    """doc_id, text_hash, digest, place and size of every anchor.

    place is its first word and offset, size the words from the anchor before, to the one behind (none: 0), and its code points.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            found = []
            for text in frame["text"]:
                digest, lo, start, stop = paragraphs(text, known, least)
                at = picked(digest, width)
                gap = np.diff(at)
                before, behind = np.r_[0, gap][: len(at)], np.r_[gap, 0][: len(at)]
                found.append((digest[at], lo[at], start[at], stop[at], before << 16 | behind))
            if found:
                yield _found(frame, found)

    return _hashed(docs).mapInPandas(run, _UNITS)


def units_near(docs: DataFrame, places: DataFrame, least: int = PARAGRAPH, width: int = MARKED - PARAGRAPH + 1) -> DataFrame:
    """Rows like those of ``units`` for all paragraphs under ``width`` words before or behind ``places`` (doc_id, text_hash, lo, first, last: which sides)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            found = []
            for text, near in zip(frame["text"], frame["near"]):
                digest, lo, start, stop = paragraphs(text, known, least)
                edges = np.zeros(len(digest) + 1, dtype=np.int64)
                place, first, last = np.array([(x["lo"], x["first"], x["last"]) for x in near], dtype=np.int64).T
                np.add.at(edges, np.maximum(place - first * (width - 1), 0), 1)
                np.add.at(edges, np.minimum(place + last * (width - 1) + 1, len(digest)), -1)
                at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
                found.append((digest[at], lo[at], start[at], stop[at], np.zeros(len(at), dtype=np.int64)))
            if found:
                yield _found(frame, found)

    wanted = places.groupBy(F.col("doc_id").alias("near_id"), F.col("text_hash").alias("near_hash")).agg(
        F.collect_set(F.struct("lo", "first", "last")).alias("near")  # at most the anchors of one text
    )
    same = F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_hash") == F.col("near_hash"))
    rows = _hashed(docs).join(wanted, same).select("doc_id", "text_hash", "text", "near")
    return rows.mapInPandas(run, _UNITS)


def repeated(found: DataFrame) -> DataFrame:
    """The stored rows of ``units`` whose digest others have, with their numbers apart."""
    # Most paragraphs stand alone: they are counted out before anything but their digest is grouped.
    digests = saved(found.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"))
    low = lambda c, bits: F.col(c).bitwiseAND(2**bits - 1)
    return saved(
        found.join(digests, "digest").select(
            "digest", "doc_id", "text_hash", F.coalesce("doc_id", F.lit(_LAST)).alias("own"), F.shiftright("place", 32).alias("lo"),
            low("place", 32).alias("start"), low("size", 32).alias("length"), F.shiftright("size", 48).alias("before"),
            F.shiftright("size", 32).bitwiseAND(2**16 - 1).alias("behind"),
        )
    )


def later(known: DataFrame, least: int) -> DataFrame:
    """Those of the stored rows ``known`` that are not the earliest of their digest, with that one as ``first``."""
    groups = saved(known.groupBy("digest").agg(F.min(F.struct("own", "text_hash", "lo")).alias("first")))
    same = (F.col("own") == F.col("first.own")) & (F.col("text_hash") == F.col("first.text_hash"))
    return known.join(groups, "digest").filter(~same | (F.col("lo") >= F.col("first.lo") + least))


def repeated_units(docs: DataFrame, min_words: int = MARKED, least: int = PARAGRAPH) -> DataFrame:
    """Passages to remove: those of ``repeated_passages`` without text_hash."""
    return repeated_passages(docs, min_words, least).drop("text_hash")


def repeated_passages(docs: DataFrame, min_words: int = MARKED, least: int = PARAGRAPH) -> DataFrame:
    """Passages to remove: doc_id, text_hash, start, length, n_words, kept_doc_id.

    start and length are code points in the original text; kept_doc_id is the document that keeps the passage's beginning.
    The earliest occurrence has the smallest doc_id (null last), then the smallest text_hash, then the smallest position; an occurrence that overlaps the
    earliest one in its own text is left alone. Repeated rows of one document tie and are one occurrence, so all of them keep
    it. Null and short texts have no paragraphs; no rows give no rows. Of ``docs`` only doc_id and text are read.
    """
    width = max(1, min_words - least + 1)
    known = repeated(saved(units(docs, least, width)))
    # A marked anchor whose neighbours are not both marked stands near an end.
    order = W.partitionBy("doc_id", "text_hash").orderBy("lo")
    anchors = later(known, least).select("digest", "doc_id", "text_hash", "lo", "before", "behind").repartition("doc_id", "text_hash").distinct()
    first = F.coalesce(F.lag("lo").over(order) != F.col("lo") - F.col("before"), F.lit(True))
    last = F.coalesce(F.lead("lo").over(order) != F.col("lo") + F.col("behind"), F.lit(True))
    ends = anchors.select("digest", first.alias("first"), last.alias("last")).filter("first or last")
    ends = saved(ends.groupBy("digest").agg(F.max("first").alias("first"), F.max("last").alias("last")))
    places = saved(known.join(ends, "digest").select("doc_id", "text_hash", "lo", "first", "last"))
    near = repeated(saved(units_near(docs, places, least, width)))
    marks = (
        later(known.unionByName(near), least)
        .select(
            "doc_id", "text_hash", "lo", (F.col("lo") + least).alias("hi"), "start", (F.col("start") + F.col("length")).alias("stop"),
            F.col("first.own").alias("kept"),
        )
        .repartition("doc_id", "text_hash")  # one shuffle for all that follows
        .distinct()
    )
    # Marks of one text that touch or overlap are one passage: at most the paragraphs of a text in a window.
    order = W.partitionBy("doc_id", "text_hash").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = marks.withColumn("opens", F.coalesce(F.col("lo") > before, F.lit(True)).cast("int"))
    joined = opened.withColumn("passage", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    spans = joined.groupBy("doc_id", "text_hash", "passage").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max("hi") - F.min("lo")).alias("n_words"), F.min_by("kept", "lo").alias("kept")
    )
    return spans.filter(F.col("n_words") >= min_words).select(
        "doc_id", "text_hash", "start", (F.col("stop") - F.col("start")).alias("length"), "n_words", F.nullif("kept", F.lit(_LAST)).alias("kept_doc_id")
    )


def _with_text(row, text, docs: DataFrame):
    """``row`` with another text, and its n_chars counted anew where there is one."""
    row = row.withField("text", text)
    return row.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else row


def without_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``docs`` with its columns, the lines (doc_id, text_hash, unit) cut out of text; other rows as they are.

    A null text stays null; n_chars, where it is there, is counted anew for changed texts.
    """
    cut = lines.groupBy(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash")).agg(
        F.collect_set("unit").alias("cut")  # at most the lines of one text
    )
    rows = with_row(docs, text_hash=F.xxhash64(text_of(docs)))
    joined = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("text_hash") == F.col("cut_hash")), "left")
    left = F.array_join(
        F.filter(F.split("row.text", "\n", -1), lambda x, i: ~F.array_contains(F.col("cut"), i.cast("long"))), "\n"
    )
    changed = _with_text(F.col("row"), left, docs)
    out = joined.select(F.when(F.col("cut").isNull(), F.col("row")).otherwise(changed).alias("row"))
    return out.select("row.*")


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with its columns, the spans (doc_id, text_hash, start, length; apart from each other) cut out of their texts.

    Spans without text_hash go to every text of their doc_id; there one beyond the end of a text cuts nothing.
    """
    hashed = "text_hash" in spans.columns
    keys = [F.col("doc_id").alias("cut_id"), *([F.col("text_hash").alias("cut_hash")] if hashed else [])]
    cut = spans.groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("cut")  # at most the passages of one text
    )
    same = F.col("doc_id").eqNullSafe(F.col("cut_id"))
    same = same & (F.col("text_hash") == F.col("cut_hash")) if hashed else same
    joined = with_row(docs, text_hash=F.xxhash64(text_of(docs))).join(cut, same, "left")
    # Between the end of one span and the start of the next.
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("cut", lambda s: s["start"] + s["length"]))
    begins = F.concat(F.transform("cut", lambda s: s["start"]), F.array(F.length("row.text").cast("long")))
    pieces = F.zip_with(
        ends, begins, lambda a, b: F.substring(F.col("row.text"), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    )
    changed = _with_text(F.col("row"), F.array_join(pieces, ""), docs)
    out = joined.select(F.when(F.col("cut").isNull() | F.col("row.text").isNull(), F.col("row")).otherwise(changed).alias("row"))
    return out.select("row.*")


def kept_documents(docs: DataFrame, min_words: int = MARKED) -> DataFrame:
    """All rows of ``docs`` with later occurrences of long passages cut out of their texts."""
    return without_spans(docs, repeated_passages(docs, min_words))
