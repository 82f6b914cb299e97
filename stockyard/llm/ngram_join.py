"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles. Equal sets are one *class* from the start, so copies are never paired. Classes are
joined by a random recursion, repeated in independent runs:

* At a node of the tree a set chooses the shingle that hashes least under the node's own hash function and follows it to
  a child. Two sets choose the same one with probability equal to their similarity. The path so far seeds the next
  hash, so all paths of a set, for all runs, come from one pass over its text.
* A bucket of at most ``BUCKET`` sets is compared by brute force. A larger one is split by the next choice, unless more
  than half of it would stay together: then its sets are alike, splitting only loses recall, and it is compared as it is.
* Large buckets are compared in blocks, pair of blocks by pair of blocks, so no task holds more than two blocks.
* A set takes part in runs until the probability of having missed a pair at the threshold, the product of
  (1 - threshold^depth) over its runs, is below 1 - ``RECALL``.

A block returns, for each of its sets, the number of its links there and one link to the least set it reaches; never the
pairs. A pair met in several runs counts in the first one that brings the two sets together, which both rows carry. The
links are exact Jaccard over whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved, streamed_groups, text_of, without
from stockyard.llm.components import components
from stockyard.llm.shingles import MIX, WordHashes, shingle_set, words_of

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
BUCKET = BLOCK = 384
DEPTH = 3
_SEED = 0x5851F42D4C957F2D
_LAST = 2**63 - 1


def most_runs(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs that reach the recall even if every bucket is split to the full depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def paths(tokens: np.ndarray, runs: int, depth: int = DEPTH) -> list[int]:
    """Path keys, ``depth`` for each run."""
    out = []
    for run in range(runs):
        path = (_SEED * (2 * run + 1)) & 0xFFFFFFFFFFFFFFFF
        for _ in range(depth):
            seeded = tokens ^ np.uint64(path)
            token = int(tokens[np.argmin((seeded ^ (seeded >> np.uint64(31))) * MIX)])
            path = ((path ^ token) * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF
            path ^= path >> 32
            out.append(path - 2**64 if path >= 2**63 else path)
    return out


def profiles(docs: DataFrame, words: int, runs: int, depth: int) -> DataFrame:
    """doc_id, text_hash, size of the set, its 128-bit signature (s1, s2) and its path keys."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            rows = []
            for text in frame["text"]:
                tokens = shingle_set(known.of(words_of(text.lower())), words)
                if not len(tokens):
                    rows.append((0, 0, 0, []))
                    continue
                marks = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), dtype=np.int64)
                rows.append((len(tokens), int(marks[0]), int(marks[1]), paths(tokens, runs, depth)))
            found = pd.DataFrame(rows, columns=["size", "s1", "s2", "keys"])
            yield pd.concat([frame[["doc_id", "text_hash"]].astype({"doc_id": "Int64"}).reset_index(drop=True), found], axis=1)

    text = text_of(docs)
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInPandas(run, "doc_id long, text_hash long, size long, s1 long, s2 long, keys array<long>")


def final_buckets(classes: DataFrame, runs: int, depth: int, bucket: int) -> DataFrame:
    """(s1, s2, run, bucket, depth, n): where each class is compared in each run.

    Classes alone at the first level are left out; one that is alone only after a split has a row with the depth it came to.
    """
    level_keys = [F.element_at("keys", F.col("run") * depth + i + 1).alias(f"k{i + 1}") for i in range(depth)]
    at = classes.select("s1", "s2", "keys", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))).alias("run")).select("s1", "s2", "run", *level_keys)
    settled = None
    for level in range(1, depth + 1):
        key = f"k{level}"
        counts = saved(at.groupBy("run", key).agg(F.count("*").alias("n")).filter("n > 1" if level == 1 else "true"))
        there = saved(at.join(counts, ["run", key]))
        done = F.col("n") <= bucket if level < depth else F.lit(True)
        if level < depth:
            # Is one child so large that the bucket's sets must be alike?
            child = there.filter(~done).groupBy("run", key, f"k{level + 1}", "n").agg(F.count("*").alias("c"))
            alike = child.groupBy("run", key, "n").agg(F.max("c").alias("most")).filter("2 * most > n").select("run", key, F.lit(True).alias("alike"))
            there = there.join(saved(alike), ["run", key], "left")
            done = done | F.coalesce("alike", F.lit(False))
        ready = there.filter(done).select("s1", "s2", "run", F.col(key).alias("bucket"), F.lit(level).alias("depth"), "n")
        settled = ready if settled is None else settled.unionByName(ready)
        at = there.filter(~done).select("s1", "s2", "run", *[f"k{i + 1}" for i in range(depth)])
    return settled


def used_runs(runs: int, found: list[tuple[int, int, int, int]], threshold: float, recall: float) -> list[tuple[int, int, int]]:
    """(run, bucket, n) of the runs a class takes part in, until its recall is reached. Alone from the start (no row): depth 1."""
    by_run = {r: (bucket, depth, n) for r, bucket, depth, n in found}
    miss, out = 1.0, []
    for run in range(runs):
        if miss <= 1 - recall:
            break
        bucket, depth, n = by_run.get(run, (0, 1, 1))
        miss *= 1 - threshold**depth
        if n > 1:
            out.append((run, bucket, n))
    return out


def to_blocks(docs: DataFrame, words: int, runs: int, threshold: float, recall: float, block: int) -> DataFrame:
    """One row for each set and pair of blocks it is compared in. ``docs``: text, s1, s2, copies, found."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            out, held = [], 0
            for text, s1, s2, copies, found in frame[["text", "s1", "s2", "copies", "found"]].itertuples(index=False):
                places = used_runs(runs, [(f["run"], f["bucket"], f["depth"], f["n"]) for f in found], threshold, recall)
                if not places:
                    continue
                data = shingle_set(known.of(words_of(text.lower())), words).tobytes()
                met = [0] * runs
                for number, bucket, _ in places:
                    met[number] = bucket
                for number, bucket, n in places:
                    blocks = -(-n // block)
                    own = (s1 ^ number) % blocks
                    for other in range(blocks):
                        a, b = min(own, other), max(own, other)
                        out.append((number, bucket, a, b, own == a, s1, s2, copies, met, data))
                        held += len(data)
                        if held > 8_000_000:
                            yield pd.DataFrame(out, columns=columns)
                            out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    columns = "run bucket a b first s1 s2 copies met tokens".split()
    schema = "run int, bucket long, a int, b int, first boolean, s1 long, s2 long, copies long, met array<long>, tokens binary"
    return docs.mapInPandas(run, schema)


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections; shingles are handled a slice at a time, those of one set not at all."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.float32)
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[inverse]
    row, column = of[keep], number[inverse[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = int(shared.sum())
    for at in range(0, total, columns):
        a, b = np.searchsorted(column, [at, at + columns])
        members, local = np.unique(row[a:b], return_inverse=True)
        part = np.zeros((len(members), min(columns, total - at)), dtype=np.float32)
        part[local, column[a:b] - at] = 1
        out[np.ix_(members, members)] += part @ part.T
    return out


def links_of(group: pd.DataFrame, threshold: float) -> pd.DataFrame | None:
    """For each set of one pair of blocks with a link: s1, s2, links, and the least set it reaches here (r1, r2)."""
    group = group.drop_duplicates(["s1", "s2"]).sort_values(["s1", "s2"], ignore_index=True)
    if len(group) < 2:
        return None
    run, a, b = int(group["run"].iloc[0]), group["a"].iloc[0], group["b"].iloc[0]
    sets = [np.frombuffer(t, dtype=np.uint64) for t in group["tokens"]]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    if sizes.min() < threshold * sizes.max() and len(sets) == 2:
        return None
    both = overlaps(sets).astype(np.float64)
    linked = both * (1 + threshold) >= threshold * (sizes[:, None] + sizes[None, :]) - 1e-9
    np.fill_diagonal(linked, False)
    if a != b:
        first = group["first"].to_numpy()
        linked &= first[:, None] != first[None, :]
    if run and linked.any():
        met = np.array(group["met"].tolist(), dtype=np.int64)[:, :run]
        x, y = linked.nonzero()
        linked[x, y] = ~((met[x] == met[y]) & (met[x] != 0)).any(axis=1)  # an earlier run had this pair
    some = linked.any(axis=1)
    if not some.any():
        return None
    label = np.arange(len(group))
    while True:
        near = np.minimum(label, np.where(linked, label[None, :], len(group)).min(axis=1))
        near = near[near]
        if (near == label).all():
            break
        label = near
    keys = group[["s1", "s2"]].to_numpy()
    weight = linked @ group["copies"].to_numpy()
    return pd.DataFrame(
        {"s1": keys[some, 0], "s2": keys[some, 1], "links": weight[some], "r1": keys[label[some], 0], "r2": keys[label[some], 1]}
    )


def similar(
    docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH,
    bucket: int = BUCKET, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, class_id, n_links, kept.

    class_id is the least doc_id of the texts connected by links, n_links the number of other rows whose text has at least
    ``threshold`` Jaccard similarity (copies included), kept marks the class's first text. Words are cut at blanks and lower-cased; a text
    with fewer words than a shingle is one shingle. Texts without words (null, empty) link to nothing and are a class each.
    A null doc_id comes after all others. Repeated rows are copies that link to each other; they share ``kept``. Other columns are
    not read; no rows give no rows.
    """
    runs = most_runs(threshold, recall, depth)
    rows = saved(profiles(docs, words, runs, depth))
    order = F.coalesce("doc_id", F.lit(_LAST))
    classes = saved(
        rows.filter("size > 0")
        .groupBy("s1", "s2")
        .agg(
            F.min(F.struct(order.alias("o"), "text_hash", "doc_id")).alias("head"), F.count("*").alias("copies"),
            F.any_value("keys").alias("keys"),
        )
    )
    met = final_buckets(classes, runs, depth, bucket)
    found = met.groupBy("s1", "s2").agg(F.collect_list(F.struct("run", "bucket", "depth", "n")).alias("found"))  # one for each run at most
    heads = classes.select("s1", "s2", "copies", "head").join(found, ["s1", "s2"])
    heads = saved(heads.select("s1", "s2", "copies", "found", F.col("head.doc_id").alias("_id"), F.col("head.text_hash").alias("_hash")))
    texts = docs.select("doc_id", F.xxhash64(text_of(docs)).alias("text_hash"), text_of(docs).alias("text"))
    compared = texts.join(heads, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    compared = compared.select("text", "s1", "s2", "copies", "found")
    blocks = to_blocks(compared, words, runs, threshold, recall, block)
    sides = ["run", "bucket", "a", "b"]

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in streamed_groups(frames, sides):
            if (out := links_of(group, threshold)) is not None:
                yield out

    dealt = blocks.repartition(*sides).sortWithinPartitions(*sides)
    linked = saved(dealt.mapInPandas(link, "s1 long, s2 long, links long, r1 long, r2 long"))
    sums = linked.groupBy("s1", "s2").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.struct("s1", "s2").alias("a"), F.struct(F.col("r1").alias("s1"), F.col("r2").alias("s2")).alias("b")))
    roots = roots.select("node.s1", "node.s2", "root")
    named = classes.select("s1", "s2", "head", "copies").join(roots, ["s1", "s2"], "left").join(sums, ["s1", "s2"], "left")
    named = saved(named.withColumn("root", F.coalesce("root", F.struct("s1", "s2"))))
    firsts = saved(named.groupBy("root").agg(F.min("head").alias("first")))
    settled = named.join(firsts, "root").select(
        "s1", "s2", F.col("first").alias("first"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    settled = saved(settled)  # joins of two stored sides are those that adaptive execution splits
    joined = rows.filter("size > 0").select("doc_id", "text_hash", "s1", "s2").join(settled, ["s1", "s2"])
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    empty = rows.filter("size = 0").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept")
    )
    return joined.select("doc_id", "text_hash", F.col("first.doc_id").alias("class_id"), "n_links", stays.alias("kept")).unionByName(empty)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text stands for its class."""
    return without(docs, similar(docs).filter(~F.col("kept")))
