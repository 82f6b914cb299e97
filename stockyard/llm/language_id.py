"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: for every context of up to ``ORDER`` bytes the counts of the bytes that followed it in a
bounded training sample. Statistics are frozen; a byte is coded in the longest known context, and each context that has not
seen it costs its escape (method C: a context with n symbols, d of them distinct, gives a symbol seen c times c / (n + d)
and the escape d / (n + d)). Below order 0 all 256 bytes are equally likely. The least code length of the whole text wins.

With frozen counts the cost of a byte depends on it and the ``ORDER`` bytes before it alone. So the trees are flattened
into one table from byte window to exact cost per language, for the windows that some language has seen; a window unknown to all falls back, as
escapes do, to the next shorter one plus the escape cost of its context. Texts are scored as arrays of windows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import text_of

ORDER = 4
#: Bound of the training sample: whole texts of each language until about so many bytes, at most so many texts. Texts over an eighth
#: of the bytes come after the others: of at most eight of them the beginnings fill what is left.
SAMPLE_BYTES, SAMPLE_TEXTS = 400_000, 2_000
PIECE = 1_000_000  # bytes scored at once
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """True for the rows never learned from; a null doc_id is held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def training_sample(docs: DataFrame, size: int = SAMPLE_BYTES, texts: int = SAMPLE_TEXTS) -> dict[str, list[bytes]]:
    """A bounded sample of texts of every language, the same for the same rows.

    Per language the ``texts`` rows with the least hash are found by a bounded aggregate in every task; of them at most ``size`` bytes are fetched.
    Where texts of up to ``size // 8`` bytes do not fill ``size``, the beginnings of up to eight longer ones do.
    """
    usable = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), text_of(docs).alias("text"))
    usable = usable.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 0))
    # Only hash, length and id move; short texts come first so that the sample holds many.
    marks = usable.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.octet_length("text").alias("n"))
    short = F.col("n") <= size // 8
    counts = {r["lang"]: r["longer"] for r in marks.groupBy("lang").agg(F.count_if(~short).alias("longer")).collect()}  # a row per language
    chosen = []
    for lang in sorted(counts):
        own = marks.filter((F.col("lang") == lang) & short).orderBy("h").limit(texts)
        total = 0
        for row in own.collect():
            if total >= size:
                break
            chosen.append((lang, row["h"], row["n"]))
            total += row["n"]
        if total < size and counts[lang]:
            longer = marks.filter((F.col("lang") == lang) & ~short).select("h", "n").distinct().orderBy("h").limit(min(8, texts)).collect()
            for left, row in zip(range(len(longer), 0, -1), sorted(longer, key=lambda r: r["n"])):
                part = min(row["n"], -(-(size - total) // left))
                chosen.append((lang, row["h"], part))
                total += part
    spark = docs.sparkSession
    wanted = spark.createDataFrame(chosen, "lang string, h long, part long") if chosen else None
    out: dict[str, list[bytes]] = {lang: [] for lang in sorted(counts)}
    if wanted is not None:
        rows = usable.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(wanted), ["lang", "h"])
        rows = rows.select("lang", "h", "part", F.left("text", F.col("part").cast("int")).alias("text")).distinct()
        for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["h"])):
            data = row["text"].encode()
            whole = len(data) <= row["part"]
            out[row["lang"]].append(data if whole else data[: row["part"]].decode(errors="ignore").encode())
    return {lang: texts for lang, texts in out.items() if texts}


def windows(data: np.ndarray, size: int) -> np.ndarray:
    """Each byte with the ``size - 1`` bytes before it as one number, from byte ``size - 1`` on."""
    n = len(data) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size):
        if n > 0:
            out = (out << np.uint64(8)) | data[i : i + n].astype(np.uint64)
    return out


class Lookup:
    """Row number of a key, -1 if absent: open addressing, probed for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.rows = np.full(1 << self.bits, -1, dtype=np.int32)
        self.steps = 0
        todo = np.arange(len(keys))
        while len(todo):
            at = self._at(keys[todo], self.steps)
            free = self.rows[at] < 0
            _, first = np.unique(at[free], return_index=True)
            put = todo[free][first]
            self.keys[at[free][first]] = keys[put]
            self.rows[at[free][first]] = put
            left = np.ones(len(todo), dtype=bool)
            left[free.nonzero()[0][first]] = False
            todo = todo[left]
            self.steps += 1

    def _at(self, keys: np.ndarray, step: int) -> np.ndarray:
        spot = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return (spot + np.uint64(step)) & np.uint64((1 << self.bits) - 1) if step else spot

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._at(keys, 0)
        out = np.where(self.keys[at] == keys, self.rows[at], -1)
        for step in range(1, self.steps):
            miss = (out < 0).nonzero()[0]
            if not len(miss):
                break
            at = self._at(keys[miss], step)
            out[miss] = np.where(self.keys[at] == keys[miss], self.rows[at], -1)
        return out


class Model:
    """Frozen context trees of all languages; costs in bits."""

    def __init__(self, sample: dict[str, list[bytes]], order: int = ORDER):
        self.langs, self.order = sorted(sample), order
        grams = [[self._counts(sample[lang], k) for lang in self.langs] for k in range(1, order + 2)]
        # Contexts of order k are what windows of k + 1 bytes begin with: n and d per context.
        self.contexts, self.escapes = [], []
        known: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(order + 1):
            every = np.unique(np.concatenate([np.unique(w >> np.uint64(8)) for w, _ in grams[k]])) if self.langs else np.zeros(0, np.uint64)
            n, d = np.zeros((len(every), len(self.langs))), np.zeros((len(every), len(self.langs)))
            for i, (w, c) in enumerate(grams[k]):
                at = np.searchsorted(every, w >> np.uint64(8))
                np.add.at(n[:, i], at, c)
                np.add.at(d[:, i], at, 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                self.escapes.append(np.where(n > 0, -np.log2(d / (n + d)), 0.0))  # an unknown context costs nothing
            self.contexts.append(every)
            known.append((n, d))
        self.windows, self.costs = [], []
        for k in range(order + 1):
            every = np.unique(np.concatenate([w for w, _ in grams[k]])) if self.langs else np.zeros(0, np.uint64)
            context = np.searchsorted(self.contexts[k], every >> np.uint64(8))
            n, d = known[k]
            shorter = self._shorter(k, every)
            cost = self.escapes[k][context] + shorter
            for i, (w, c) in enumerate(grams[k]):
                at = np.searchsorted(every, w)
                own = context[at]
                cost[at, i] = -np.log2(c / (n[own, i] + d[own, i]))
            self.windows.append(every)
            self.costs.append(cost)
        self._ready = False

    @staticmethod
    def _counts(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [windows(np.frombuffer(t, dtype=np.uint8), size) for t in texts]
        return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def _shorter(self, k: int, every: np.ndarray) -> np.ndarray:
        """Cost of the windows' last k bytes in the trees up to order k - 1 (each such window is known)."""
        if k == 0:
            return np.full((len(every), len(self.langs)), 8.0)
        tail = every & np.uint64((1 << (8 * k)) - 1)
        return self.costs[k - 1][np.searchsorted(self.windows[k - 1], tail)]

    def ready(self) -> Model:
        if not self._ready:
            self.find_window = [Lookup(w) for w in self.windows]
            self.find_context = [Lookup(c) for c in self.contexts]
            self._ready = True
        return self

    def costs_of(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per text and language. ``data``: the texts' bytes end to end; ``starts``: where each begins."""
        n = len(data)
        total = np.zeros((len(starts), len(self.langs)))
        if not n:
            return total
        text = np.repeat(np.arange(len(starts)), np.diff([*starts, n]))
        place = np.arange(n) - np.asarray(starts)[text]
        code = np.zeros(n, dtype=np.uint64)
        code[self.order :] = windows(data, self.order + 1)
        for k in range(min(self.order, n)):
            head = place[: n] == k
            at = head.nonzero()[0]
            value = np.zeros(len(at), dtype=np.uint64)
            for back in range(k, -1, -1):
                value = (value << np.uint64(8)) | data[at - back].astype(np.uint64)
            code[at] = value
        level = np.minimum(place, self.order)
        for k in range(self.order, -1, -1):
            at = slice(None) if k == self.order and (level == k).all() else (level == k).nonzero()[0]
            own = code[at] if isinstance(at, slice) else code[at]
            if not len(own):
                continue
            row = self.find_window[k](own)
            hit = row >= 0
            where = np.arange(n) if isinstance(at, slice) else at
            self._add(total, text[where[hit]], self.costs[k], row[hit])
            miss = where[~hit]
            if len(miss):
                context = self.find_context[k](code[miss] >> np.uint64(8))
                seen = context >= 0
                self._add(total, text[miss[seen]], self.escapes[k], context[seen])
                if k:
                    level[miss] = k - 1
                    code[miss] &= np.uint64((1 << (8 * k)) - 1)
                else:
                    total += 8.0 * np.bincount(text[miss], minlength=len(starts))[:, None]
        return total

    @staticmethod
    def _add(total: np.ndarray, text: np.ndarray, costs: np.ndarray, row: np.ndarray) -> None:
        """Add cost rows to their texts; ``text`` is ascending."""
        if len(text):
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            total[text[first]] += np.add.reduceat(costs[row], first, axis=0)


def exact_cost(texts: list[bytes], data: bytes, order: int = ORDER) -> float:
    """The definition, byte by byte, for one language (used to test the tables)."""
    trees: list[dict[bytes, Counter]] = [{} for _ in range(order + 1)]
    for text in texts:
        for i in range(len(text)):
            for k in range(min(order, i) + 1):
                trees[k].setdefault(text[i - k : i], Counter())[text[i]] += 1
    bits = 0.0
    for i, byte in enumerate(data):
        for k in range(min(order, i), -1, -1):
            node = trees[k].get(data[i - k : i])
            if node is None:
                continue
            n, d = sum(node.values()), len(node)
            if byte in node:
                bits -= math.log2(node[byte] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def identified(docs: DataFrame, order: int = ORDER, size: int = SAMPLE_BYTES, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``score`` is the share of the best language if every language's likelihood per byte, in bits, is weighed against the
    others' (1 / number of languages: no difference). Null texts and texts without a letter are ``und`` with score 0, as all are if no
    language can be learned. Ties go to the first language by name. Learned from text and lang of rows that are not held out;
    a row with null doc_id is held out. Repeated rows each get their result; other columns are not read.
    """
    spark = docs.sparkSession
    model = Model(training_sample(docs, size, texts), order)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample: about 30 bytes for each of its windows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value.ready()
        for frame in frames:
            blobs = [t.encode() for t in frame["text"]]
            bits = np.zeros((len(blobs), max(1, len(own.langs))))
            a = 0
            while a < len(blobs):
                b, held = a, 0
                while b < len(blobs) and (b == a or held + len(blobs[b]) <= PIECE):
                    held += len(blobs[b])
                    b += 1
                data = np.frombuffer(b"".join(blobs[a:b]), dtype=np.uint8)
                starts = np.cumsum([0, *map(len, blobs[a : b - 1])])
                if own.langs:
                    filled = np.array([len(x) > 0 for x in blobs[a:b]])
                    bits[a:b][filled] = own.costs_of(data, starts[filled])
                a = b
            known = frame["letters"].to_numpy(dtype=bool) & bool(own.langs)
            best = bits.argmin(axis=1)
            per_byte = (bits.min(axis=1, keepdims=True) - bits) / np.maximum(1, [[len(x)] for x in blobs])
            score = 1 / np.exp2(8 * per_byte).sum(axis=1)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "held_out": frame["held_out"],
                    "lang_pred": [own.langs[i] if ok else UNDETERMINED for i, ok in zip(best, known)],
                    "score": np.where(known, score, 0.0),
                }
            )

    text = text_of(docs)
    rows = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.regexp_like(text, F.lit(r"\p{L}")).alias("letters"), text.alias("text")
    )
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
