"""Ranked lexical search by exact inner products in sparse ball trees.

A document is a sparse vector over the terms of the queries, of what each term's frequency earns; a query is the vector of its
terms' weights, and the score their inner product. Documents are dealt to shards of bounded size; a task builds one
shard's ball tree (nodes split between two distant documents, each with centroid and radius) and searches it for every query
best first. Terms that no document below a node holds add nothing there, so with q the query without them no document
below scores more than q . centroid + |q| * radius; that bound is rounded up by more than the arithmetic can lose, so a node
is passed over only if it cannot hold one of the best. Leaves are scored in whole numbers. The best of the shards are
merged.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockyard.llm.common import saved, streamed_groups, text_of

TOP = 50
#: Terms of queries that are searched in one pass; more are dealt to several passes over the documents' vectors.
TERMS_A_PASS = 200_000
SHARD_DOCS, SHARD_ENTRIES = 8192, 2_000_000
LEAF = 32
#: What a bound is raised by, relative to the largest number that went into it.
SLACK = 1e-9
#: Every ASCII character but letters and digits ends a term; capitals A-Z become small.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_NO_ID = np.iinfo(np.int64).max


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


# --- the tree ----------------------------------------------------------------------------------


class BallTree:
    """Documents as rows of a sparse matrix: entries ``starts[i]`` to ``starts[i + 1]`` of ``terms`` and ``values``."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF):
        self.width = width
        self.order = np.arange(len(starts) - 1)
        sizes = np.diff(starts)
        floats = values.astype(np.float64)
        squares = self._row_sums(floats * floats, starts)
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self.radii: list[float] = []
        at_term, at_node, at_value = [], [], []
        todo = [(0, len(self.order), None, 0)] if len(self.order) else []
        while todo:
            low, high, parent, side = todo.pop()
            rows = self.order[low:high]
            entries = np.repeat(starts[rows], sizes[rows]) + _within(sizes[rows])
            inner = np.r_[0, np.cumsum(sizes[rows])]
            local, value = terms[entries], floats[entries]
            centroid = np.bincount(local, value, width) / len(rows)
            far = squares[rows] - 2 * self._row_sums(value * centroid[local], inner) + centroid @ centroid
            reach = squares[rows].max() + centroid @ centroid
            node = len(self.spans)
            self.spans.append((low, high))
            self.children.append(None)
            self.radii.append(math.sqrt(max(0.0, far.max()) + SLACK * reach))
            held = np.flatnonzero(centroid)
            at_term.append(held)
            at_node.append(np.full(len(held), node))
            at_value.append(centroid[held])
            if parent is not None:
                before = self.children[parent] or (0, 0)
                self.children[parent] = (before[0], node) if side else (node, before[1])
            if len(rows) > leaf:
                first = self._from(rows, int(far.argmax()), starts, terms, floats, local, value, inner)
                second = self._from(rows, int((squares[rows] - 2 * first).argmax()), starts, terms, floats, local, value, inner)
                along = np.argsort(second - first, kind="stable")
                self.order[low:high] = rows[along]
                middle = (low + high) // 2
                todo += [(middle, high, node, 1), (low, middle, node, 0)]
        nodes = len(self.spans)
        term = np.concatenate(at_term) if nodes else np.zeros(0, np.int64)
        by_term = np.argsort(term, kind="stable")
        self.at = np.searchsorted(term[by_term], np.arange(width + 1))
        self.of = (np.concatenate(at_node) if nodes else term)[by_term]
        self.centre = (np.concatenate(at_value) if nodes else np.zeros(0))[by_term]
        self.radius = np.array(self.radii)
        rows = self.order
        entries = np.repeat(starts[rows], sizes[rows]) + _within(sizes[rows])
        self.terms, self.values, self.starts = terms[entries], values[entries], np.r_[0, np.cumsum(sizes[rows])]

    @staticmethod
    def _row_sums(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sums = np.r_[np.zeros(1, numbers.dtype), np.cumsum(numbers)]
        return sums[starts[1:]] - sums[starts[:-1]]

    def _from(self, rows, nth, starts, terms, floats, local, value, inner) -> np.ndarray:
        """Products of the node's rows with its ``nth`` one."""
        a, b = starts[rows[nth]], starts[rows[nth] + 1]
        pivot = np.zeros(self.width)
        pivot[terms[a:b]] = floats[a:b]
        return self._row_sums(value * pivot[local], inner)

    def bounds(self, query: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each node, a number that no document below it scores above."""
        sizes = self.at[query + 1] - self.at[query]
        cells = np.repeat(self.at[query], sizes) + _within(sizes)
        nodes, own = self.of[cells], np.repeat(weights.astype(np.float64), sizes)
        centre = np.bincount(nodes, self.centre[cells] * own, len(self.radius))
        reach = centre + np.sqrt(np.bincount(nodes, own * own, len(self.radius))) * self.radius
        return reach * (1 + SLACK) + 1

    def scores(self, node: int, wanted: np.ndarray) -> np.ndarray:
        """Whole-number scores of a leaf's documents; ``wanted``: the query as a full vector."""
        low, high = self.spans[node]
        a, b = self.starts[low], self.starts[high]
        return self._row_sums(self.values[a:b] * wanted[self.terms[a:b]], self.starts[low : high + 1] - a)

    def best(self, query: np.ndarray, weights: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(positions, scores) of the best documents above zero for the terms ``query`` with ``weights``, equal scores by
        ``ids``, and the number of leaves opened."""
        wanted = np.zeros(self.width, dtype=np.int64)
        wanted[query] = weights
        reach = self.bounds(query, weights)
        queue = [(-reach[0], 0)] if len(reach) else []
        found_at, found, least, opened = np.zeros(0, np.int64), np.zeros(0, np.int64), 1, 0
        while queue and -queue[0][0] >= least:  # an equal score may still win by its id
            node = heapq.heappop(queue)[1]
            if self.children[node]:
                for child in self.children[node]:
                    if reach[child] >= least:
                        heapq.heappush(queue, (-reach[child], child))
                continue
            opened += 1
            score = self.scores(node, wanted)
            good = np.flatnonzero(score >= least)
            if len(good):
                found_at = np.r_[found_at, self.order[self.spans[node][0] + good]]
                found = np.r_[found, score[good]]
                if len(found) > top:
                    kept = np.lexsort((ids[found_at], -found))[:top]
                    found_at, found = found_at[kept], found[kept]
                if len(found) == top:
                    least = int(found.min())
        return found_at, found, opened


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for each size in turn."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


# --- the search --------------------------------------------------------------------------------


def queries_of(items: DataFrame) -> DataFrame:
    """(item_id, query, terms): the different items with their different terms; ``query`` numbers them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(terms=[sorted(set(terms_of(text))) for text in frame["text"]])[["item_id", "terms"]]

    rows = items.select("item_id", text_of(items).alias("text")).distinct().mapInPandas(run, "item_id long, terms array<binary>")
    return rows.filter("size(terms) > 0").withColumn("query", F.monotonically_increasing_id())


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms, terms, times: each document's length and its counts of the vocabulary's terms."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = known.value.get
        for frame in frames:
            rows = []
            for text in frame["text"]:
                found = terms_of(text)
                times = Counter(map(number, found))
                times.pop(None, None)
                rows.append((len(found), list(times), list(times.values())))
            out = pd.DataFrame(rows, columns=["n_terms", "terms", "times"])
            yield out.assign(doc_id=frame["doc_id"].astype("Int64").to_numpy())[["doc_id", "n_terms", "terms", "times"]]

    rows = docs.select("doc_id", text_of(docs).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_terms long, terms array<int>, times array<int>")


def _search_pass(docs: DataFrame, items: list, top: int) -> DataFrame:
    """query, doc_id, score: the best of every shard for each of ``items`` (query, terms)."""
    spark = docs.sparkSession
    words = sorted({term for item in items for term in item["terms"]})
    number = {bytes(term): i for i, term in enumerate(words)}
    vectors = saved(counted(docs, number).filter("n_terms > 0").withColumn("row", F.monotonically_increasing_id()))
    total = vectors.agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    n_docs, all_terms, entries = (int(x) for x in total)
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = np.zeros(len(words), dtype=np.int64)
    for term, df in holding.collect():  # a pass's terms at most
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    queries = [(item["query"], np.array(sorted(number[bytes(t)] for t in item["terms"]))) for item in items]
    shared = spark.sparkContext.broadcast((weight, queries))
    shards = max(1, -(-n_docs // SHARD_DOCS), -(-entries // SHARD_ENTRIES))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, asked = shared.value
        for shard in streamed_groups(frames, ["shard"]):
            sizes = shard["terms"].map(len).to_numpy()
            starts = np.r_[0, np.cumsum(sizes)]
            terms = np.concatenate(shard["terms"].to_numpy()).astype(np.int64)
            times = np.concatenate(shard["times"].to_numpy()).astype(np.int64)
            length = np.repeat(100 - 50 + (50 * shard["n_terms"].to_numpy() * n_docs) // all_terms, sizes)
            values = (1_000_000_000 * times) // (1000 * times + 20 * length)
            ids = shard["doc_id"].astype("Int64")
            order = ids.fillna(_NO_ID).to_numpy(dtype=np.int64)
            # the vectors' columns: only terms that the shard holds
            held, local = np.unique(terms, return_inverse=True)
            tree = BallTree(starts, local, values, max(1, len(held)))
            for query, wanted in asked:
                at = np.searchsorted(held, wanted)
                at = at[(at < len(held)) & (held[np.minimum(at, max(0, len(held) - 1))] == wanted)] if len(held) else at[:0]
                if len(at):
                    found, score, _ = tree.best(at, weights[held[at]], order, top)
                    if len(found):
                        yield pd.DataFrame({"query": query, "doc_id": ids.iloc[found].to_numpy(), "score": score})

    dealt = vectors.filter("size(terms) > 0").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    tasks = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "row")
    return tasks.mapInPandas(run, "query long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring rows of ``docs`` for each item, equal scores by doc_id.

    Null and empty texts have no terms: such documents count nowhere and such items have no rows. Rows that repeat a
    document are documents of their own; a null id comes last among equals. Items with equal item_id and text are one
    item; other texts of one item_id are ranked each. Very long texts are read whole. Other columns are not
    read. Empty tables give no rows. What is broadcast and collected is bounded by the terms of one pass.
    """
    asked = saved(queries_of(items))
    terms = int(asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0])
    passes = max(1, -(-terms // TERMS_A_PASS))
    found = None
    for nth in range(passes):
        here = asked.filter(F.pmod(F.xxhash64("query"), F.lit(passes)) == nth).select("query", "terms").collect()
        part = saved(_search_pass(docs, here, top))
        found = part if found is None else found.unionByName(part)
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return placed.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


#: The definition in DuckDB's SQL, over the views ``documents`` and ``benchmark``.
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
held AS (SELECT r, doc_id, len(terms) AS n, terms FROM doc WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM held),
item AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS term FROM item),
word AS (SELECT r, unnest(terms) AS term FROM held),
found AS (SELECT r, term, count(*) AS tf FROM word WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM found, total GROUP BY term),
earned AS (
  SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))) AS s
  FROM found JOIN held USING (r) JOIN weight USING (term), total),
scored AS (SELECT item_id, text, r, doc_id, sum(s)::BIGINT AS score FROM asked JOIN earned USING (term) GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS nth FROM scored WHERE score > 0)
SELECT item_id, nth::INTEGER AS rank, doc_id, score FROM placed WHERE nth <= {TOP}
"""
