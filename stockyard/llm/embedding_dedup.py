"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors of one label are one class. The classes of a label lie in blocks; every two blocks of a label are a tile.
In a tile all vectors have unit length and are turned onto the principal axes of the table, the strongest first. A tile adds up
products axis group by axis group; what the remaining axes can add is at most the product of the two remaining
norms, so a pair that cannot reach the threshold any more is dropped, and the tile stops when no pair is left. The pairs that
remain are decided on the vectors as they were given. A tile returns a row for each class with links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import saved, streamed_groups
from stockyard.llm.components import components

THRESHOLD = 0.93
BLOCK = 1024
#: Vectors of more components, and of other lengths than the commonest ones, keep the order of their components: the axes
#: only speed things up, any order gives the same pairs.
MOST_AXES, FITTED = 512, 3
#: Axes that are added before pairs are dropped for the first time; each later group doubles them.
FIRST_AXES = 8
#: More than rounding can take from a bound.
SLACK = 1e-9
_DENSE = 0.25
_TOGETHER = 1 << 16


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their norms; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The cosine of each two rows, in double precision."""
    left, right = (side / np.abs(side).max(axis=1, keepdims=True) for side in (left, right))
    return (left * right).sum(axis=1) / np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))


def _suffixes(vectors: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norms of what lies behind each edge."""
    squares = np.cumsum((vectors * vectors)[:, ::-1], axis=1)[:, ::-1]
    behind = np.concatenate([squares, np.zeros((len(vectors), 1))], axis=1)
    return np.sqrt(behind[:, edges])


def close_pairs(left: np.ndarray, right: np.ndarray, axes: np.ndarray | None, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (in ``left``, in ``right``) of the pairs with a cosine of at least ``threshold``; with ``same``, each pair once."""
    turned = [unit_rows(side) if axes is None else unit_rows(side) @ axes for side in (left, right)]
    width = left.shape[1]
    edges = [0]
    while edges[-1] < width:
        edges.append(min(width, max(FIRST_AXES, 2 * edges[-1])))
    rest = [_suffixes(side, edges) for side in turned]
    least = threshold - SLACK
    sums = np.zeros((len(left), len(right)))
    alive = np.triu(np.ones(sums.shape, dtype=bool), 1) if same else None
    step = 0
    while step + 1 < len(edges):
        a, b = edges[step], edges[step + 1]
        sums += turned[0][:, a:b] @ turned[1][:, a:b].T
        step += 1
        can = sums + rest[0][:, step][:, None] * rest[1][:, step][None] >= least
        alive = can if alive is None else alive & can
        left_over = np.count_nonzero(alive)
        if not left_over:
            return
        if left_over < _DENSE * sums.size:
            break
    rows, columns = np.nonzero(alive)
    for start in range(0, len(rows), _TOGETHER):
        at, of = rows[start : start + _TOGETHER], columns[start : start + _TOGETHER]
        partial = sums[at, of]
        for a, b, nth in zip(edges[step:], edges[step + 1 :], range(step + 1, len(edges))):
            partial = partial + (turned[0][at, a:b] * turned[1][of, a:b]).sum(axis=1)
            can = partial + rest[0][at, nth] * rest[1][of, nth] >= least
            at, of, partial = at[can], of[can], partial[can]
            if not len(at):
                break
        if len(at):
            sure = cosines(left[at], right[of]) >= threshold
            yield at[sure], of[sure]


def roots_of(size: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least position that links reach from each position."""
    root = np.arange(size)
    while True:
        lower = root.copy()
        for at, of in pairs:
            np.minimum.at(lower, at, lower[of])
            np.minimum.at(lower, of, lower[at])
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def axes_of(classes: DataFrame, width: int) -> np.ndarray | None:
    """Principal axes of the unit vectors with ``width`` components, strongest first: sums of products, added up by Spark."""
    if width > MOST_AXES:
        return None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for frame in frames:
            for start in range(0, len(frame), BLOCK):
                rows = unit_rows(np.stack(frame["embedding"].to_numpy()[start : start + BLOCK]).astype(np.float64))
                total += rows.T @ rows
        at, of = np.triu_indices(width)
        yield pd.DataFrame({"i": at, "j": of, "s": total[at, of]})

    sums = classes.filter(F.size("embedding") == width).select("embedding").mapInPandas(run, "i int, j int, s double")
    found = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # at most MOST_AXES * (MOST_AXES + 1) / 2 numbers
    table = np.zeros((width, width))
    for i, j, s in found:
        table[i, j] = table[j, i] = s
    return np.linalg.eigh(table)[1][:, ::-1]


def links(classes: DataFrame, axes: dict[int, np.ndarray | None], threshold: float = THRESHOLD) -> DataFrame:
    """(node, met, root) of the classes (node, label, embedding, n) for each tile that links them.

    ``met``: vectors of other classes linked directly; ``root``: a class that the tile's links reach. A hot label has
    as many blocks as it needs, and tiles are dealt by label and both blocks.
    """
    spark = classes.sparkSession
    sizes = classes.withColumn("width", F.size("embedding")).groupBy("label", "width").agg(F.count("*").alias("members"))
    sizes = saved(sizes.withColumn("blocks", F.ceil(F.col("members") / BLOCK)))
    dealt = classes.withColumn("width", F.size("embedding")).join(sizes, ["label", "width"])
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tiles = dealt.select(
        "node", "label", "width", "embedding", "n", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ).select(
        "node", "label", "width", "embedding", "n", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")
    )
    turned = spark.sparkContext.broadcast(axes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tile in streamed_groups(frames, ["label", "width", "a", "b"]):
            one, other, width = int(tile["a"].iloc[0]), int(tile["b"].iloc[0]), int(tile["width"].iloc[0])
            tile = tile.sort_values(["own", "node"], kind="stable", ignore_index=True)
            vectors = np.stack(tile["embedding"].to_numpy()).astype(np.float64)
            own, weight = tile["own"].to_numpy(), tile["n"].to_numpy().astype(np.float64)
            left = np.flatnonzero(own == one)
            right = left if one == other else np.flatnonzero(own == other)
            if not len(left) or not len(right):
                continue
            met, pairs = np.zeros(len(tile)), []
            for at, of in close_pairs(vectors[left], vectors[right], turned.value.get(width), threshold, one == other):
                at, of = left[at], right[of]
                met += np.bincount(at, weight[of], len(tile)) + np.bincount(of, weight[at], len(tile))
                pairs.append((at, of))
            linked = np.flatnonzero(met)
            if len(linked):
                nodes = tile["node"].to_numpy()
                yield pd.DataFrame({"node": nodes[linked], "met": met[linked].astype(np.int64), "root": nodes[roots_of(len(tile), pairs)[linked]]})

    return tiles.repartition("label", "width", "a", "b").sortWithinPartitions("label", "width", "a", "b").mapInPandas(run, "node long, met long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Only rows with equal labels and as many components are compared. A null label, a null, empty or zero vector, or a component
    that is null or not finite: no links. Equal rows are vectors of their own and link with each other; kept rows are those
    whose id is the least of their component, so rows that share it are all kept; a null id comes after all others and is
    kept only if its component has no id at all. Other columns are not read. No rows give no rows.
    """
    whole = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("whole", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("whole").isNotNull() & finite & F.exists("whole", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", whole.alias("whole"))
    rows = rows.select("vec_id", "label", F.col("whole").alias("embedding"), F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = saved(rows)
    classes = rows.filter("usable").groupBy("label", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()))
    often = classes.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").limit(FITTED).collect()
    axes = {row["width"]: axes_of(classes, row["width"]) for row in often}
    found = saved(links(classes, axes, threshold))
    met = found.groupBy("node").agg(F.sum("met").alias("met"))
    roots = saved(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    placed = saved(
        classes.join(met, "node", "left").join(roots, "node", "left")
        .select("node", "label", "embedding", "n", "least_id", F.coalesce("met", F.lit(0)).alias("met"), F.coalesce("root", "node").alias("root"))
    )
    least = saved(placed.groupBy("root").agg(F.min("least_id").alias("component_id")))
    judged = saved(placed.join(least, "root").select("label", "embedding", (F.col("met") + F.col("n") - 1).alias("n_links"), "component_id"))
    linked = rows.filter("usable").join(judged, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: The definition in DuckDB's SQL, over the view ``embeddings``.
ORACLE = f"""
WITH RECURSIVE vec AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
unit AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM vec WHERE usable),
link AS (
  SELECT a.r AS a, b.r AS b FROM unit a JOIN unit b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD}),
reach(a, b) AS (SELECT r, r FROM vec UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
least AS (SELECT reach.a AS r, min(vec_id) AS component_id FROM reach JOIN vec ON vec.r = reach.b GROUP BY reach.a),
met AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vec LEFT JOIN met USING (r) JOIN least USING (r)
"""
