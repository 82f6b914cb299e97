"""BPE encoding and decoding with a public word-end vocabulary.

A word's symbols form a doubly linked list; a priority queue holds (merge rank, position) of adjacent pairs. The least rank
is merged, the neighbours' new pairs are pushed, and entries whose pair has changed meanwhile are skipped as stale.
Decoding concatenates vocabulary strings, one blank between tokens, as the vocabulary file (which names no decoder) asks.

White space never takes part in a token, so the runs between blanks are encoded on their own and remembered; a task
holds about ``KEPT`` of them and as many words.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import text_of

KEPT = 500_000
#: Unicode White_Space; str.split() also splits at 1C to 1F.
SPACE = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[^{SPACE}]+").findall
OTHER_BLANKS = re.compile("[\x1c-\x1f]").search


def runs_of(text: str) -> list[str]:
    """What stands between white space."""
    return _RUNS(text) if OTHER_BLANKS(text) else text.split()


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _ascii_only(pattern: str) -> str:
    """The same word pattern for texts of ASCII characters, in the classes of the plain ``re`` module."""
    return pattern.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9")


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split
        size = max([*self.ids.values(), *special.values()]) + 1
        self.strings = [""] * size
        for token, number in [*self.ids.items(), *special.items()]:
            self.strings[number] = token
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        self._any, self._ascii = regex.compile(split, regex.V0).findall, re.compile(_ascii_only(split), re.ASCII).findall
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + self.end] for s in symbols]
        self.known: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode()
        symbol = [self.inner[b] for b in data[:-1]]
        symbol.append(self.last[data[-1]])
        n = len(symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges.get
        # What the pair that begins at a place merges to now, or None.
        current = [merges(pair) for pair in zip(symbol, symbol[1:])]
        current.append(None)
        queue = [found[0] << 32 | at for at, found in enumerate(current) if found]
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            left = top & 0xFFFFFFFF
            found = current[left]
            if found is None or found[0] != top >> 32:
                continue  # stale: one of the two was merged before
            right = after[left]
            beyond = after[right]
            symbol[left], symbol[right], current[right] = found[1], -1, None
            after[left] = beyond
            current[left] = None
            if beyond >= 0:
                before[beyond] = left
                if new := merges((symbol[left], symbol[beyond])):
                    current[left] = new
                    heapq.heappush(queue, new[0] << 32 | left)
            ahead = before[left]
            if ahead >= 0:
                current[ahead] = new = merges((symbol[ahead], symbol[left]))
                if new:
                    heapq.heappush(queue, new[0] << 32 | ahead)
        return [s for s in symbol if s >= 0]

    def _word(self, word: str) -> bytes:
        found = self.known_words.get(word)
        if found is None:
            found = self.known_words[word] = np.array(self.merge(word), dtype="<u4").tobytes()
        return found

    def _run(self, run: str) -> bytes:
        if "<" not in run:
            return self._plain(run)
        return b"".join(
            self.special[part].to_bytes(4, "little") if part in self.special else self._plain(part) for part in self.cut(run)
        )

    @staticmethod
    def plain(text: str) -> str:
        """Composed and in lower case, letter by letter: no final form of sigma."""
        return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def words(self, text: str) -> list[str]:
        return self._ascii(text) if text.isascii() else self._any(text)

    def _plain(self, part: str) -> bytes:
        return b"".join(map(self._word, self.words(self.plain(part))))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEPT:
            self.known.clear()
        if len(self.known_words) > KEPT:
            self.known_words.clear()
        known = self.known
        runs = runs_of(text)
        for run in {*runs}.difference(known):
            known[run] = self._run(run)
        return b"".join(map(known.__getitem__, runs))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """The vocabulary file, read once in each Python worker."""
    return Bpe(path)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded (string) of every row.

    Null and empty texts have no ids and decode to the empty text. Strings of special tokens inside a text become those
    tokens. Repeated rows each get their result; only doc_id and text are read; no rows give no rows.
    """
    path = path or vocabulary_path()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for frame in frames:
            ids = [bpe.encode(t) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "ids": ids, "decoded": [bpe.decode(i) for i in ids]})

    return docs.select("doc_id", text_of(docs).alias("text")).mapInPandas(run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    rows = encoded(docs, path)
    return rows.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
