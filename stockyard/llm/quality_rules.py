"""Quality rules with cross-document line frequency.

One pass over the texts counts the base statistics and, for every line, the hash of its normal form. Then, per host (the
column ``source``): in how many contents does a line stand? A line in more than ``max(MIN_DOCS, SHARE of the host's different
texts)`` is boilerplate and removed; a document that this leaves with too little is rejected.

Copies of one document share all their lines without being boilerplate, so equal texts count once, and near copies by what
they have of their own: each line has a sketch, the least hash of its five-word shingles, which an edited line mostly
keeps; a text's signature is the least sketch among those that are rare on the host, so a shared block cannot make
unlike texts look alike, or among all if none is rare. A line's contents are the signatures of its texts. A line whose
contents are not more than ``VARIETY`` times its different texts stands in near copies.
The counts are aggregates in steps with map-side combining: a host, line or group of copies with a third of all rows is
combined in every task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.bpe import OTHER_BLANKS
from stockyard.llm.common import saved, text_of, without
from stockyard.llm.line_dedup import without_lines
from stockyard.llm.shingles import WordHashes, hash64, window_hashes, words_of

MIN_WORDS = 20
MAX_REPEATED = 30  # percent of the words
WINDOW = 8
MIN_DOCS, SHARE, VARIETY = 10, 0.01, 0.5
#: A document is depleted if the removed lines leave under this share of its words.
LEFT = 0.3
SYMBOLS = "#*$%&|<>"


def repeated_words(words: np.ndarray, size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that the text holds at least twice."""
    windows = window_hashes(words, size)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    inner = windows[order]
    same = inner[1:] == inner[:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = twice.nonzero()[0]
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def sketches(words: np.ndarray, sizes: np.ndarray, size: int = 5) -> np.ndarray:
    """The least shingle hash of each line; ``sizes``: words of the lines. A line with fewer words is one shingle."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    starts = np.cumsum(sizes) - sizes
    for n in range(1, size):
        at = np.flatnonzero(sizes == n)
        if len(at):
            out[at] = window_hashes(words, n)[starts[at]]
    at = np.flatnonzero(sizes >= size)
    if len(at):
        inner = np.repeat(starts[at] + sizes[at], sizes[at]) - size >= (
            np.arange(sizes[at].sum()) - np.repeat(np.cumsum(sizes[at]) - sizes[at] - starts[at], sizes[at])
        )
        places = np.flatnonzero(np.repeat(sizes >= size, sizes))[inner]
        counts = sizes[at] - size + 1
        out[at] = np.minimum.reduceat(window_hashes(words, size)[places], np.cumsum(counts) - counts)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """Base statistics and the hashed lines of every row with their sketches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            rows = []
            for text in frame["text"]:
                words = words_of(text)
                hashed = known.of(words)
                cut = str.split if text.isascii() and not OTHER_BLANKS(text) else words_of
                seen, dup, hashes, counts, numbers = set(), 0, [], [], []
                for number, line in enumerate(text.split("\n")):
                    inner = cut(line)
                    if not inner:
                        continue
                    dup += line in seen
                    seen.add(line)
                    hashes.append(hash64(" ".join(inner).lower()))
                    counts.append(len(inner))
                    numbers.append(number)
                rows.append(
                    (
                        len(words),
                        sum(map(len, words)),
                        sum(map(text.count, SYMBOLS)),
                        dup,
                        repeated_words(hashed),
                        hashes,
                        sketches(hashed, np.array(counts, dtype=np.int64)).astype(np.int64),
                        counts,
                        numbers,
                    )
                )
            columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words line_hashes line_least line_words line_numbers".split()
            yield pd.concat([frame.drop(columns="text").reset_index(drop=True), pd.DataFrame(rows, columns=columns)], axis=1)

    text = text_of(docs)
    schema = (
        "doc_id long, text_hash long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, line_hashes array<long>, line_least array<long>, line_words array<long>, line_numbers array<long>"
    )
    host = F.coalesce(docs["source"].cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), host.alias("host"), text.alias("text"))
    return rows.mapInPandas(run, schema)


def boilerplate(stats: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, variety: float = VARIETY) -> DataFrame:
    """(host, line) of the lines above the limit."""
    sizes = saved(stats.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_texts")))
    sketched = stats.select("host", "text_hash", F.explode(F.array_distinct("line_least")).alias("least")).distinct()
    met = sketched.groupBy("host", "least").agg(F.count("*").alias("texts")).filter(F.col("texts") > min_docs).join(sizes, "host")
    often = saved(met.filter(F.col("texts") > share * F.col("host_texts")).select("host", "least", F.lit(True).alias("often")))
    lines = F.inline(F.arrays_zip(F.col("line_hashes").alias("line"), F.col("line_least").alias("least")))
    cells = stats.select("_row", "host", "text_hash", lines).join(often, ["host", "least"], "left")
    signed = cells.groupBy("_row", "host", "text_hash").agg(
        F.coalesce(F.min(F.when(F.col("often").isNull(), F.col("least"))), F.min("least")).alias("signature"),
        F.collect_set(F.when(F.col("often"), F.col("line"))).alias("lines"),  # at most the lines of one text
    )
    seen = (
        signed.select("host", "text_hash", "signature", F.explode("lines").alias("line")).distinct()
        .groupBy("host", "line", "signature").agg(F.count("*").alias("n"))
        .groupBy("host", "line").agg(F.sum("n").alias("texts"), F.count("*").alias("contents"))
    )
    return (
        seen.filter((F.col("contents") > min_docs) & (F.col("contents") > variety * F.col("texts")))
        .join(sizes, "host")
        .filter(F.col("contents") > share * F.col("host_texts"))
        .select("host", "line")
    )


def judged(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, variety: float = VARIETY, left: float = LEFT):
    """(verdicts, removed lines).

    Verdicts: one row per row of ``docs``: doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_removed_words, base_failed, kept. Removed lines: doc_id, text_hash, unit of the lines above the limits.

    A null text has no words and fails; a null source is the host ''. Repeated rows are rows of their own, but one
    content. Columns other than doc_id, text and source are not read. No rows give no rows.
    """
    stats = saved(measured(docs).withColumn("_row", F.expr("uuid()")))
    common = saved(boilerplate(stats, min_docs, share, variety))  # a join of two stored sides is one that adaptive execution splits
    cells = stats.select(
        "_row", "doc_id", "text_hash", "host",
        F.inline(F.arrays_zip(F.col("line_hashes").alias("line"), F.col("line_words").alias("words"), F.col("line_numbers").alias("unit"))),
    )
    removed = cells.join(common, ["host", "line"], "left_semi")
    lost = removed.groupBy(F.col("_row").alias("_of")).agg(F.sum("words").alias("n_removed_words"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rest = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & (rest < left * F.col("n_words"))
    verdicts = (
        stats.join(lost, F.col("_row") == F.col("_of"), "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .select(
            "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
            "base_failed", "kept",
        )
    )
    return verdicts, removed.select("doc_id", "text_hash", "unit")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns, boilerplate lines cut out of the text."""
    verdicts, removed = judged(docs)
    return without_lines(without(docs, verdicts.filter(~F.col("kept"))), removed)
