"""Ids by the tokenizers library, with words remembered.

Texts are cut into words and the different words of a batch are numbered, both in Arrow. The library is asked once for each
word that is not remembered; the words of a request share one text, and the word-end mark of their last tokens tells
them apart again. Texts are put together from the ids of their words by number.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from stockyard.llm import bpe

_TOGETHER = 64
_KEPT = 600_000
#: Characters of the texts that are coded together; a longer text is alone.
BATCH = 4_000_000


def batches(texts: Iterable[str], size: int = BATCH) -> Iterator[list[str]]:
    held, length = [], 0
    for text in texts:
        if held and length + len(text) > size:
            yield held
            held, length = [], 0
        held.append(text)
        length += len(text)
    if held:
        yield held


def _class(pattern: str) -> str:
    """The code points that ``pattern`` matches, as ranges that any pattern library reads alike."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    runs = ((run[0][0], run[0][-1]) for run in regex.finditer(f"(?:{pattern})+", every))
    return "".join(f"\\x{{{ord(a):x}}}-\\x{{{ord(b):x}}}" for a, b in runs)


class Recent(dict):
    """A memory of what was used lately: when it is full, what the last filling has not used is forgotten."""

    def __init__(self, kept: int = _KEPT):
        self.kept, self.before = kept, {}

    def absent(self, keys: set[str]) -> set[str]:
        """The keys that are not known; the others are held until the next call."""
        if len(self) > self.kept:
            self.before = dict(self)
            self.clear()
        fresh = keys.difference(self)
        if self.before:
            found = fresh.intersection(self.before)
            self.update((key, self.before[key]) for key in found)
            fresh -= found
        return fresh


class Library:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.bare = Tokenizer.from_file(path), Tokenizer.from_file(path)
        for tokenizer in (self.tokenizer, self.bare):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        # Words come normalised and cut; what is left to do is the bytes and the merges.
        self.bare.normalizer = normalizers.Sequence([])
        cut = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(cut)
        own = bpe.load(path)
        self.plain = own.plain
        self.special = re.compile("|".join(map(re.escape, own.special))).search
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith(own.end)]] = True
        self.known = Recent()
        letters, digits = _class(r"\p{L}"), _class(r"\p{N}")
        # The pattern of the vocabulary file; which alternative comes first is told by its first character.
        self.cut = rf"[{letters}]+|[{digits}]|'(?:s|t|re|ve|m|ll|d)|[^{bpe.SPACE}{letters}{digits}]+"

    def _learn(self, words: list[str]) -> None:
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        found = self.bare.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, ids in zip(groups, (e.ids for e in found)):
            data, ends = array("I", ids).tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) != len(group):
                raise ValueError("the vocabulary does not mark the ends of words")
            self.known.update((word, data[a:b]) for word, a, b in zip(group, [0, *ends], ends))

    def _whole(self, text: str) -> bytes:
        """By the library itself: texts that spell special tokens, and separators that only some call white space."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Equal texts are coded once."""
        coded = dict.fromkeys(texts)
        odd = [text for text in coded if self.special(text) or bpe.OTHER_BLANKS(text)]
        coded.update((text, self._whole(text)) for text in odd)
        usual = [text for text, ids in coded.items() if ids is None]
        plain = pa.array(map(self.plain, usual), pa.large_string(), size=len(usual))
        words = pc.utf8_split_whitespace(pc.replace_substring_regex(plain, self.cut, r"\0 "))
        numbered = words.flatten().dictionary_encode()
        different, which = numbered.dictionary.to_pylist(), numbered.indices.to_numpy(zero_copy_only=False)
        if fresh := self.known.absent({*different} - {""}):
            self._learn(list(fresh))
        parts = [self.known[word] if word else b"" for word in different]
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        starts = np.cumsum(sizes) - sizes
        sizes, starts = sizes[which], starts[which]
        ends = np.cumsum(sizes)
        tokens = ids[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.r_[0, ends][words.offsets.to_numpy()].tolist()
        coded.update((text, tokens[a:b].tobytes()) for text, a, b in zip(usual, edges, edges[1:]))
        return [coded[text] for text in texts]


@lru_cache(maxsize=4)
def load(path: str) -> Library:
    """One for each file in each Python worker."""
    return Library(path)
