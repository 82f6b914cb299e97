"""HTML extraction with host suffix arrays.

Pages are cut into blocks of text; each block is *marked out* (navigation, forms, notices...), *marked in* (inside an article or
main element) or *open*. The blocks of a page are one stream of tokens. The suffixes of all streams of a host, in the order of their
tokens, are the host's suffix array: Spark deals them by ranges and sorts every range. Neighbours whose longest common prefix
has ``LONG`` tokens or more lie in one interval, and an interval with suffixes of distinct pages is a repeated run. Tokens are
compared up to ``LONG``: a longer run is covered by the intervals of its suffixes. Further suffixes stand in the order of their
pages, so that neither a host nor a run with a third of all pages is one range; pieces of an interval are put together by their
ends. All pages of all hosts are compared, wherever their rows lie and whatever their markup; n_shared tells a page's tokens in such runs.

* On pages without an article or main element repetition decides alone: covered tokens of open blocks are boilerplate and
  go, the unique runs stay.
* What an article holds is its text even where some pages quote it. A block of it goes only if it is a repeated run as a whole, on
  more pages of the host than ``MIN_PAGES`` and than ``SHARE`` of them: a notice without a telling name.

Pages with equal html are one page in all counts, so copies do not make each other boilerplate.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved
from stockyard.llm.shingles import WordHashes, hash64, window_hashes
from stockyard.llm.url_filters import host_and_path

LONG = 8
MIN_PAGES, SHARE = 10, 0.5
PIECE = 20_000
OUT, IN, OPEN = 0, 1, 2

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S)
_UNENDED = re.compile(r"<[a-zA-Z!?/]")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_JOINTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
RAW = frozenset("script style title textarea noscript template iframe svg math object select option noembed noframes".split())
EXCLUDED = frozenset("nav header footer aside form button menu dialog head label fieldset".split()) | RAW
#: What a class, id or role calls a part of the page which is not its text: the last word of a name that says more than that it
#: holds something ("site-footer", "cookie-notice-box", but neither "share-price" nor "no-sidebar").
PARTS_OUT = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies "
    "disclaimer disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted related "
    "replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toc toolbar widget alert "
    "contentinfo complementary dialog".split()
)
_HOLDERS = frozenset("area bar block body box buttons button container content group inner item items link links list outer panel section slot unit widget wrap wrapper".split())
_SAYS_NOT = frozenset("has hide is no non not with without".split())
_REPLIES = frozenset("comment comments commentlist replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose end also ends what was left open inside them.
STRUCTURE = frozenset(
    "article aside blockquote body center details dialog div dl fieldset figure footer form header html main menu nav ol section table ul".split()
)
#: Elements that one of their own kind ends.
IMPLIED = frozenset("dd dt li option p td th tr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def part_named(name: str) -> str:
    """The word that tells what a class or id names; none if it says what is absent or what something has."""
    words = [w for w in _JOINTS.split(_HUMPS.sub("-", name).lower()) if w and not w.isdigit()]
    if not words or words[0] in _SAYS_NOT:
        return ""
    while len(words) > 1 and words[-1] in _HOLDERS:
        words.pop()
    return words[-1]


def named_out(element: str, attributes: str) -> bool:
    """Do class, id, role or a hidden mark say that this is not the page's text?

    A heading is only out if it is hidden, an article if it is hidden or a reader's comment.
    """
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name in ("class", "id", "role") and element not in HEADINGS:
            out = _REPLIES if element in ("article", "main") else PARTS_OUT
            if not out.isdisjoint(map(part_named, value.split())):
                return True
    return False


def blocks_of(page: str) -> list[tuple[int, str]]:
    """(mark, text) of the non-empty blocks in page order; references decoded, white space collapsed."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    opened: list[str] = []  # structure that is open, and the excluded element
    inside: list[int] = []  # where article and main elements stand in it
    skipped = -1  # where the excluded element stands in it
    at = 0
    lower = None

    def close() -> None:
        if text:
            plain = " ".join(html.unescape("".join(text)).split())
            if plain:
                out.append((OUT if skipped >= 0 else IN if inside else OPEN, plain))
            text.clear()

    def end(place: int) -> None:
        """End the element that stands at ``place`` and all that was left open in it."""
        nonlocal skipped
        del opened[place:]
        if skipped >= place:
            skipped = -1
        while inside and inside[-1] >= place:
            inside.pop()

    while tag := _TAG.search(page, at):
        if tag.start() > at:
            text.append(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = tag.group(1, 2, 3) if tag[2] else tag.group(4, 5, 6)  # the latter: a quote is left open
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in BLOCKS or skipped >= 0 and name == opened[skipped]:
                close()
            elif name == "br":
                text.append(" ")
            if name in opened:
                end(len(opened) - 1 - opened[::-1].index(name))
            continue
        empty = name in VOID
        if name in BLOCKS:
            close()
        elif empty:
            text.append(" " if name == "br" else "")
        if empty:
            continue
        if name in RAW:
            if lower is None:
                lower = page.lower()
                if len(lower) != len(page):  # some letters grow in lower case
                    lower = "".join(c if len(c.lower()) != 1 else c.lower() for c in page)
            stop = lower.find(f"</{name}", at)
            at = len(page) if stop < 0 else stop
            continue
        container = name in ("article", "main") or ("main" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes))
        bad = name in EXCLUDED or (bool(attributes) and name not in ("html", "body") and named_out(name, attributes))
        if skipped >= 0:
            unclosed = container and not bad and opened[skipped] not in ("form", "aside") and not inside
            if unclosed or name in IMPLIED and name == opened[skipped] and skipped == len(opened) - 1:
                close()
                end(skipped)
            else:
                if name in STRUCTURE or name == opened[skipped]:
                    opened.append(name)
                continue
        if bad:
            close()
            skipped = len(opened)
        elif container:
            close()
            inside.append(len(opened))
        if bad or container or name in STRUCTURE:
            opened.append(name)
    tail = page[at:]
    if unended := _UNENDED.search(tail):
        tail = tail[: unended.start()]
    text.append(tail)
    close()
    return out


def tokens_of(texts: Iterable[str], known: WordHashes) -> np.ndarray:
    return known.of([word for text in texts for word in text.split(" ")])


def covered(prefixes: np.ndarray, repeated: np.ndarray, long: int = LONG) -> np.ndarray:
    """Which tokens of a stream lie in a run that begins with one of the ``repeated`` prefixes."""
    edges = np.zeros(len(prefixes) + long, dtype=np.int64)
    starts = np.flatnonzero(np.isin(prefixes, repeated))
    edges[starts] += 1
    edges[starts + long] -= 1
    return np.cumsum(edges)[: len(prefixes) + long - 1] > 0


_PARSED = "row long, page_id long, url string, host string, content long, marked boolean, marks array<int>, texts array<string>, runs array<long>"


def parsed(pages: DataFrame, long: int = LONG) -> DataFrame:
    """The blocks of every page. ``runs``: the hashes of its different marked-in blocks of at least ``long`` tokens."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blocks = [blocks_of(page) for page in frame["html"]]
            yield frame.drop(columns="html").assign(
                page_id=frame["page_id"].astype("Int64"),
                marked=[any(mark == IN for mark, _ in found) for found in blocks],
                marks=[[mark for mark, _ in found] for found in blocks],
                texts=[[text for _, text in found] for found in blocks],
                runs=[sorted({hash64(t) for mark, t in found if mark == IN and t.count(" ") + 1 >= long}) for found in blocks],
            )[[field.split()[0] for field in _PARSED.split(", ")]]

    host, _ = host_and_path(F.col("url"))
    html_of = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html_of.alias("html"))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", F.coalesce(host, F.lit("")).alias("host"),
        F.xxhash64("html").alias("content"), "html",
    )
    return rows.mapInPandas(run, _PARSED)


def suffix_array(blocks: DataFrame, long: int = LONG) -> DataFrame:
    """host, tokens, content: the suffixes of every host in the order of their first ``long`` tokens.

    ``tokens`` holds the hashes of these as big-endian bytes, which Spark sorts as the tokens themselves; suffixes of a page that begin
    alike stand once, as do pages with equal html. Suffixes with fewer tokens begin no run and are left out.
    """

    def packed(pages: list[tuple[str, int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(tokens) for _, _, tokens in pages]
        of = np.repeat(np.arange(len(pages)), sizes)
        ends = pa.py_buffer((np.arange(len(of) + 1) * 8 * long).astype(np.int32))
        tokens = pa.py_buffer(np.concatenate([tokens for _, _, tokens in pages]).astype(">u8").tobytes())
        columns = [
            pa.array([host for host, _, _ in pages]).take(pa.array(of)), pa.Array.from_buffers(pa.binary(), len(of), [None, ends, tokens]),
            pa.array(np.array([content for _, content, _ in pages])[of]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["host", "tokens", "content"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            held, size = [], 0
            for host, content, texts in zip(*(column.to_pylist() for column in batch.columns)):
                stream = tokens_of(texts, known)
                _, places = np.unique(window_hashes(stream, long), return_index=True)
                for at in range(0, len(places), PIECE):
                    tokens = np.lib.stride_tricks.sliding_window_view(stream, long)[places[at : at + PIECE]]
                    held.append((host, content, tokens))
                    size += len(tokens)
                    if size >= PIECE:
                        yield packed(held)
                        held, size = [], 0
            if held:
                yield packed(held)

    pages = blocks.select("host", "content", "texts").dropDuplicates(["host", "content"])
    found = pages.mapInArrow(run, "host string, tokens binary, content long")
    return found.repartitionByRange("host", "tokens", "content").sortWithinPartitions("host", "tokens", "content")


def common_prefixes(hosts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each suffix of a piece of the array, how many first tokens it shares with the one before it; 0 for the first."""
    shared = np.zeros(len(tokens), dtype=np.int64)
    alike = np.logical_and.accumulate(tokens[1:] == tokens[:-1], axis=1).sum(axis=1)
    shared[1:] = np.where(hosts[1:] == hosts[:-1], alike, 0)
    return shared


def members(array: DataFrame, long: int = LONG) -> DataFrame:
    """host, prefix, content: the suffixes that share ``long`` tokens with a neighbour in the array, or may do so in the next piece."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in frames:  # rows that follow one another in the array
            if not len(piece):
                continue
            tokens = np.frombuffer(b"".join(piece["tokens"]), dtype=">u8").reshape(len(piece), long)
            begins = common_prefixes(piece["host"].to_numpy(), tokens) < long
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(piece)) - 1
            told = (first < last) | (first == 0) | (last == len(piece) - 1)  # or the interval may go on in the next piece
            own = np.flatnonzero(told[np.cumsum(begins) - 1])
            streams = tokens[own].astype(np.uint64).T
            yield piece[["host"]].iloc[own].assign(
                prefix=window_hashes(streams, long)[0].astype(np.int64), content=piece["content"].to_numpy()[own]
            )  # a column of tokens is the stream of a suffix

    return array.mapInPandas(run, "host string, prefix long, content long")


def _shared(held: DataFrame) -> DataFrame:
    whole = held.groupBy("host", "prefix").agg(F.min("content").alias("a"), F.max("content").alias("b"))
    return whole.filter("a != b").select("host", "prefix")


def intervals(array: DataFrame, long: int = LONG) -> DataFrame:
    """host, prefix: the intervals of the suffix array with a common prefix of ``long`` tokens that distinct pages hold."""
    return _shared(members(array, long))


def repeated_runs(blocks: DataFrame, long: int = LONG) -> DataFrame:
    """row, repeated: for every page, the prefixes of its suffixes that another page of the host holds."""
    held = saved(members(suffix_array(blocks, long), long))
    runs = saved(_shared(held))
    own = held.join(runs, ["host", "prefix"]).groupBy("host", "content").agg(F.collect_list("prefix").alias("repeated"))  # of one page
    return blocks.select("row", "host", "content").join(own, ["host", "content"]).select("row", "repeated")


def common_blocks(blocks: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """row, common: the hashes of a page's article blocks that stand on most pages of the host."""
    sizes = blocks.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    cells = saved(blocks.filter("size(runs) > 0").select("host", "content", "row", F.explode("runs").alias("run")))
    held = cells.select("host", "run", "content").distinct().groupBy("host", "run").agg(F.count("*").alias("on"))
    often = held.filter(F.col("on") > min_pages).join(sizes, "host").filter(F.col("on") > share * F.col("pages"))
    often = saved(often.select("host", "run"))
    return cells.join(often, ["host", "run"]).groupBy("row").agg(F.collect_list("run").alias("common"))  # of one page


def main_text(marks, texts, marked: bool, repeated, common, known: WordHashes, long: int = LONG) -> tuple[str, int, int, int]:
    """(text, tokens, tokens taken out as repeated, tokens in repeated runs) of a page."""
    kept, lost = [], 0
    stream = tokens_of(texts, known)
    gone = np.zeros(len(stream), dtype=bool)
    if len(repeated):
        gone = covered(window_hashes(stream, long), np.asarray(repeated, dtype=np.int64).astype(np.uint64), long)
    shared = int(gone.sum())
    if marked:
        for mark, text in zip(marks, texts):
            if mark == IN:
                if len(common) and hash64(text) in common:
                    lost += text.count(" ") + 1
                else:
                    kept.append(text)
        return "\n".join(kept), len(stream), lost, shared
    at = 0
    for mark, text in zip(marks, texts):
        words = text.split(" ")
        own = gone[at : at + len(words)]
        at += len(words)
        if mark == OPEN:
            lost += int(own.sum())
            if not own.all():
                kept.append(" ".join(w for w, out in zip(words, own) if not out))
    return "\n".join(kept), len(stream), lost, shared


def extracted(pages: DataFrame, long: int = LONG, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars, n_tokens, n_repeated, n_shared.

    A null or empty html gives an empty text. Pages with a null url, or without a host in it, share the host ''. Repeated rows
    get a row each and count as one page. A very long page is read whole, by one task. n_repeated counts the tokens that
    were taken out because other pages of the host hold them, n_shared those of all blocks in runs that other pages hold, whether
    they are taken out or not. The result depends neither on the order of the rows nor
    on their partitions. Only page_id, url and html are read; no rows give no rows.
    """
    blocks = saved(parsed(pages, long))
    runs, often = repeated_runs(blocks, long), common_blocks(blocks, min_pages, share)
    decided = saved(runs.join(often, "row", "full"))
    whole = blocks.select("row", "page_id", "url", "marked", "marks", "texts").join(decided, "row", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for frame in frames:
            lists = ([[] if x is None else x for x in frame[c]] for c in ("repeated", "common"))
            found = [main_text(*page, known, long) for page in zip(frame["marks"], frame["texts"], frame["marked"], *lists)]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"].astype("Int64"),
                    "url": frame["url"],
                    "text": [t for t, *_ in found],
                    "n_chars": [len(t) for t, *_ in found],
                    "n_tokens": [n for _, n, _, _ in found],
                    "n_repeated": [n for _, _, n, _ in found],
                    "n_shared": [n for *_, n in found],
                }
            )

    return whole.mapInPandas(run, "page_id long, url string, text string, n_chars long, n_tokens long, n_repeated long, n_shared long")
