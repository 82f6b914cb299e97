"""Exact dedup by composable polynomial fingerprints.

A text, freed of blanks, is hashed in chunks: H(chunk) = sum b_i * B^(k-1-i) mod p for two primes. Chunk hashes combine by
length-shifted arithmetic, H(xy) = H(x) * B^|y| + H(y), so the chunks of a huge document are hashed in one matrix product
and joined afterwards. Texts with equal fingerprint and length are then compared chunk by chunk with the group's leader,
as rows of bounded size; a text that differs is grouped anew in a further round, so a colliding fingerprint costs time
and never a wrong answer.

Leaders meet their members by an equi-join on (group, salt, chunk). A group with a third of all rows gets one salt for
every ``SALTED`` members; only its leader is repeated, once per salt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import BLANKS, saved, text_of, with_row

HASH_CHUNK = 4096  # bytes; 255 * 2^31 * 4096 stays below 2^53, so float64 products are exact
COMPARE_CHUNK = 65_536  # characters per compared row
SALTED = 512
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 1_299_709)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.int64)
    for i in range(1, n):
        out[i] = out[i - 1] * base % prime
    return out


def shifted(base: int, prime: int, lengths: np.ndarray) -> np.ndarray:
    """B^length mod p, by squaring, for many lengths at once."""
    out, square, left = np.ones(len(lengths), dtype=np.int64), base % prime, lengths.astype(np.int64).copy()
    while left.any():
        odd = (left & 1) == 1
        out[odd] = out[odd] * square % prime
        left >>= 1
        square = square * square % prime
    return out


def fingerprints(blobs: list[bytes], primes=PRIMES, chunk: int = HASH_CHUNK) -> np.ndarray:
    """One row of residues per byte string."""
    tables = np.stack([_powers(b, p, chunk) for b, p in zip(BASES, primes)], axis=1)[::-1].astype(np.float64)
    out = np.zeros((len(blobs), len(primes)), dtype=np.int64)
    for row, blob in enumerate(blobs):
        n = len(blob)
        if not n:
            continue
        head = -n % chunk  # zeros in front change no value
        data = np.zeros(n + head, dtype=np.uint8)
        data[head:] = np.frombuffer(blob, dtype=np.uint8)
        parts = data.reshape(-1, chunk).astype(np.float64) @ tables
        behind = np.arange(len(parts) - 1, -1, -1) * chunk
        for k, (base, prime) in enumerate(zip(BASES, primes)):
            own = parts[:, k].astype(np.int64) % prime
            out[row, k] = int((own * shifted(base, prime, behind) % prime).sum() % prime)
    return out


def fingerprinted(docs: DataFrame, primes=PRIMES) -> DataFrame:
    """doc_id, n_points, n_bytes, f1, f2, text_sha256 of every row; null text counts as empty."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blobs = [t.encode() for t in frame["squeezed"]]
            marks = fingerprints(blobs, primes)
            yield frame.drop(columns="squeezed").assign(
                n_bytes=np.array([len(b) for b in blobs], dtype=np.int64), f1=marks[:, 0], f2=marks[:, 1]
            )

    text = text_of(docs)
    rows = docs.select("doc_id", F.length(text).cast("long").alias("n_points"), F.translate(text, BLANKS, "").alias("squeezed"))
    rows = rows.withColumn("text_sha256", F.sha2(F.col("squeezed"), 256))
    schema = "doc_id long, n_points long, text_sha256 string, n_bytes long, f1 long, f2 long"
    return rows.select("doc_id", "n_points", "text_sha256", "squeezed").mapInPandas(run, schema)


def _compared(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Settle which rows of a fingerprint group have the leader's text: (doc_id, text_sha256, n_points, leader).

    ``leader`` names the text class: the best row of each class of truly equal texts.
    """
    mark = ["f1", "f2", "n_bytes"]
    rows = marks.groupBy(*mark, "doc_id", "n_points", "text_sha256").agg(F.count("*").alias("repeats"))
    rows = saved(rows)
    best = F.max(F.struct("n_points", -F.coalesce("doc_id", F.lit(2**63 - 1)), "text_sha256"))
    groups = rows.groupBy(*mark).agg(best.alias("best"), F.count("*").alias("distinct_rows"))
    groups = saved(groups)  # a join of two stored sides is one that adaptive execution splits
    alone = groups.filter("distinct_rows = 1")
    settled = rows.join(alone.select(*mark), mark, "left_semi").withColumn("round", F.lit(0))
    open_rows = rows.join(groups.filter("distinct_rows > 1"), mark)
    key = ["doc_id", "n_points", "text_sha256"]

    text = text_of(docs)
    chunk = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.length("squeezed"), F.lit(1)) - 1) / COMPARE_CHUNK).cast("int")),
        lambda i: F.struct(i.alias("at"), F.substring(F.col("squeezed"), i * COMPARE_CHUNK + 1, F.lit(COMPARE_CHUNK)).alias("part")),
    )
    texts = (
        docs.select("doc_id", F.length(text).cast("long").alias("n_points"), F.translate(text, BLANKS, "").alias("squeezed"))
        .withColumn("text_sha256", F.sha2(F.col("squeezed"), 256))
    )
    number = 0
    while True:
        number += 1
        same = [F.col(f"w.{k}").eqNullSafe(F.col(f"t.{k}")) for k in key]
        wanted = open_rows.select(*mark, *key, "best", "distinct_rows")
        pieces = (
            texts.alias("t").join(wanted.alias("w"), same[0] & same[1] & same[2])
            .select("w.*", "t.squeezed")
            .select(*mark, *key, "best", "distinct_rows", F.inline(chunk))
        )
        leads = F.struct("n_points", -F.coalesce("doc_id", F.lit(2**63 - 1)), "text_sha256") == F.col("best")
        salts = F.ceil(F.col("distinct_rows") / SALTED).cast("int")
        pieces = saved(pieces.withColumn("leads", leads))
        leader = pieces.filter("leads").select(
            *mark, "at", F.col("part").alias("lead_part"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
        ).dropDuplicates([*mark, "at", "salt"])
        member = pieces.withColumn("salt", F.pmod(F.xxhash64(*key), F.ceil(F.col("distinct_rows") / SALTED)).cast("int"))
        agree = (
            member.join(leader, [*mark, "at", "salt"], "left")
            .groupBy(*mark, *key)
            .agg(F.min((F.col("part") == F.col("lead_part")).cast("int")).alias("same"))
        )
        agree = agree.select(*[F.col(c).alias(f"_{c}") for c in [*mark, *key]], F.coalesce("same", F.lit(0)).alias("same"))
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*mark, *key]]
        told = saved(open_rows.join(agree, on[0] & on[1] & on[2] & on[3] & on[4] & on[5], "left").select(open_rows["*"], F.coalesce("same", F.lit(0)).alias("same")))
        done = told.filter("same = 1").select(*rows.columns).withColumn("round", F.lit(number))
        settled = settled.unionByName(done)
        rest = told.filter("same = 0").select(*rows.columns)
        if rest.isEmpty():
            return settled
        # Texts that only share a fingerprint: the next round has a leader of its own among them.
        regrouped = saved(rest.groupBy(*mark).agg(best.alias("best"), F.count("*").alias("distinct_rows")))
        open_rows = rest.join(regrouped, mark)


def exact_duplicates(docs: DataFrame, primes=PRIMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Texts are equal when identical without blanks. Of equal texts the row with the most code points, then the smallest
    doc_id (null last) stays; of wholly repeated rows exactly one. Null text is empty; all empty texts are equal. No rows
    give no rows; other columns are not read.
    """
    settled = _compared(docs, fingerprinted(docs, primes))
    mark = ["f1", "f2", "n_bytes", "round"]
    best = F.max(F.struct("n_points", -F.coalesce("doc_id", F.lit(2**63 - 1)), "doc_id"))
    groups = saved(settled.groupBy(*mark).agg(best.alias("best"), F.sum("repeats").alias("group_size")))
    each = settled.join(groups, mark).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    stays = (
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("n_points") == F.col("best.n_points")) & (F.col("nth") == 1)
    )
    return each.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", stays.alias("kept"), "text_sha256", "n_points"
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their columns: one of each class of equal texts."""
    text = text_of(docs)
    told = exact_duplicates(docs).groupBy(F.col("doc_id").alias("told_id"), F.col("n_points").alias("told_points"), F.col("text_sha256").alias("told_sha"))
    told = saved(told.agg(F.max("kept").alias("stays"), F.count("*").alias("repeats")).filter("not stays or repeats > 1"))
    rows = with_row(docs, n_points=F.length(text).cast("long"), sha=F.sha2(F.translate(text, BLANKS, ""), 256))
    same = (
        F.col("doc_id").eqNullSafe(F.col("told_id")) & (F.col("n_points") == F.col("told_points")) & (F.col("sha") == F.col("told_sha"))
    )
    stays = rows.join(told, same, "left_anti")
    repeated = told.filter("stays")
    if not repeated.isEmpty():  # wholly repeated rows: one of each
        stays = stays.unionByName(rows.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "n_points", "sha"]))
    return stays.select("row.*")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         translate(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS s FROM documents
), g AS (
  SELECT *, count(*) OVER (PARTITION BY s) AS group_size,
         first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(s) AS text_sha256, n AS n_points FROM g
"""
