"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its words (hashed) and their shapes: case, marks before and after, digits, repetition, size of the text.
Relative frequencies, weighted by rarity among the labelled texts, are projected on the leading singular vectors of the labelled texts' matrix.
The labelled vectors, at most ``PER_CLASS`` for each label, are broadcast; every document is compared with all of them by
exact cosine products, a block of documents at a time, and its ``NEIGHBOURS`` nearest vote with their similarity.

Only the labelled sample is bounded. All documents are scored over their whole text in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved, text_of
from stockyard.llm.shingles import KEPT, words_of

#: Bound of the labelled sample, for each label.
PER_CLASS = 2048
SHAPES, WORDS, LATENT = 256, 768, 32
TERMS = SHAPES + WORDS
NEIGHBOURS, POWER, BLOCK = 25, 4, 512
CUT = 0.3
#: Terms of the text as a whole stand in front of the hashed shapes.
_SAME, _SIZE, _OWN = 0, 1, 24


def held_out(doc_id: Column) -> Column:
    """True for the rows never learned from; a null doc_id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def shape(word: str) -> str:
    """Marks and case: letters of one case become one a or A, digits one 0, other characters stay."""
    out = []
    for c in word:
        c = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "o" if c.isalpha() else c
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


class Terms(dict):
    """Word -> number that holds its shape term and its word term; emptied when large."""

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT:
            self.clear()
        form = _OWN + zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % (SHAPES - _OWN)
        plain = zlib.crc32(word.strip(".,;:!?\"'()").lower().encode("utf-8", "surrogatepass"))
        value = self[word] = plain % WORDS << 40 | plain << 8 | form  # the middle tells words apart
        return value

    def vector(self, text: str) -> np.ndarray:
        """Relative term frequencies of a text."""
        words = words_of(text)
        out = np.zeros(TERMS, dtype=np.float32)
        size = min(len(words).bit_length(), _OWN - _SIZE - 1)
        out[_SIZE + size] = 0.05
        if words:
            code = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
            out[_OWN:SHAPES] = np.bincount(code & 255, minlength=SHAPES)[_OWN:] / len(words)
            out[SHAPES:] = np.bincount(code >> 40, minlength=WORDS) / len(words)
            out[_SAME] = np.count_nonzero(code[1:] >> 8 == code[:-1] >> 8) / len(words)
        return out


class Space:
    """Latent vectors of the labelled texts and the way into their space."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, latent: int = LATENT):
        self.labels = labels.astype(np.float32)
        seen = (vectors > 0).sum(axis=0)
        self.weight = (np.log((1 + len(vectors)) / (1 + seen)) + 0.1).astype(np.float32)
        weighted = self._weighted(vectors)
        _, axes = np.linalg.eigh(weighted.T @ weighted)
        self.axes = np.ascontiguousarray(axes[:, ::-1][:, :latent]).astype(np.float32)
        self.points = self._unit(weighted @ self.axes)

    def _weighted(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(vectors) * self.weight

    @staticmethod
    def _unit(points: np.ndarray) -> np.ndarray:
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        near = self._unit(self._weighted(vectors) @ self.axes) @ self.points.T
        k = min(NEIGHBOURS, len(self.labels))
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 1e-6).astype(np.float64) ** POWER
        return np.clip((weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def labelled_space(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Space:
    """Fitted on at most ``per_class`` rows of each label, those with the least hash, that are not held out."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    usable = usable.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1)).distinct()
    texts = docs.select("doc_id", F.xxhash64(text_of(docs)).alias("h"))
    there = saved(texts.join(usable, "doc_id").select("doc_id", "h", "quality").withColumn("mark", F.xxhash64("doc_id", "h")))
    parts = [there.filter(F.col("quality") == label).orderBy("mark", "doc_id").limit(per_class) for label in (0, 1)]
    chosen = parts[0].union(parts[1]).select("doc_id", "h", "quality").distinct()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for frame in frames:
            yield pd.DataFrame({"mark": frame["mark"], "quality": frame["quality"], "vector": [terms.vector(t).tobytes() for t in frame["text"]]})

    rows = (
        docs.select("doc_id", text_of(docs).alias("text")).withColumn("h", F.xxhash64("text"))
        .join(F.broadcast(chosen), ["doc_id", "h"])  # 2 * per_class rows at most
        .select(F.xxhash64("doc_id", "h").alias("mark"), "quality", "text")
        .mapInPandas(run, "mark long, quality int, vector binary")
    )
    # Repeated rows are learned once: the bound holds whatever the tables repeat.
    found = {(r["mark"], r["quality"]): r["vector"] for r in rows.dropDuplicates(["mark", "quality"]).collect()}
    vectors = np.array([np.frombuffer(found[k], dtype=np.float32) for k in sorted(found)]).reshape(-1, TERMS)
    return Space(vectors, np.array([q for _, q in sorted(found)]))


def scored(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, cut: float = CUT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts are scored by their size term; without any label to learn from the score is 0.5. A null doc_id is
    held out; labels that are null or neither 0 nor 1 are left out. Of ``docs`` only doc_id and text are read (doc_id never for a score).
    """
    space = docs.sparkSession.sparkContext.broadcast(labelled_space(docs, labels, per_class))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, own = Terms(), space.value
        for frame in frames:
            score = np.zeros(len(frame))
            for a in range(0, len(frame), BLOCK):
                part = frame["text"].iloc[a : a + BLOCK]
                score[a : a + BLOCK] = own.scores(np.array([terms.vector(t) for t in part]))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "held_out": frame["held_out"], "score": score, "predicted": (score >= cut).astype("int32")}
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of(docs).alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")
