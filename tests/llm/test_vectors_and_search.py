"""Hard negatives, near-duplicate embeddings and ranked search against their definitions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_texts import prose

from stockyard.llm import embedding_dedup, hard_negatives, ranked_search

VECTORS = "vec_id long, embedding array<float>, label int, label2 string, parts string, node string, n string, `odd name.` string, least string"
ITEMS = "item_id long, text string, query string, terms string"
BAD = [
    (None, [0.5, 0.5], 1), (901, None, 1), (902, [0.5, None], 1), (903, [0.5, float("nan")], 1), (904, [float("inf"), 0.1], 2),
    (905, [0.5, 0.25], None), (906, [], 1), (907, [0.0, 0.0], 1), (800, None, None),
]


@pytest.fixture(scope="module")
def vectors_of(spark):
    return lambda rows: spark.createDataFrame([(*r, *["x"] * 6) for r in rows], VECTORS)


def usable(rows):
    """id -> (label, parts) by the definition."""
    found = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        parts = [math.floor(256 * float(np.float32(x))) for x in vector]
        found[vec_id] = min(found.get(vec_id, (label, parts)), (label, parts))
    return found


def mined_by_force(rows, every=100, positives=5, negatives=5):
    found, out = usable(rows), []
    for anchor, (label, parts) in found.items():
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(parts, other)), i, own) for i, (own, other) in found.items() if i != anchor]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(anchor, positive, nth, i, -p, -n) for nth, (n, i, _) in enumerate(inside, 1)]
    return Counter(out)


def rows_around(seed, n, centres, noise, dims=6, labels=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i, (middle[rng.integers(centres)] + noise * rng.normal(size=dims)).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("noise", [0.0, 0.05, 1.0])
def test_hard_negatives(vectors_of, monkeypatch, noise):
    monkeypatch.setattr(hard_negatives, "ROWS_A_BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS_A_BLOCK", 7)
    rows = rows_around(3, 300, 4, noise) + BAD + [(2000, [1.0] * 9, 1), (2000, [1.0] * 9, 1), (2100, [-3.0], 0)]
    got = hard_negatives.mined(vectors_of(rows), anchor_every=20).collect()
    want = mined_by_force(rows, every=20)
    assert Counter(map(tuple, got)) == want and len(want) > 50


def test_hard_negatives_of_little(vectors_of):
    assert hard_negatives.mined(vectors_of([])).collect() == []
    assert hard_negatives.mined(vectors_of(BAD)).collect() == []
    alone = [(100, [1.0, 1.0], 1), (201, [1.0, 1.0], 2)]
    assert hard_negatives.mined(vectors_of(alone)).collect() == []
    with pytest.raises(ValueError, match="at the most"):
        hard_negatives.mined(vectors_of(alone), most=120)


def test_keys_sort_as_they_should():
    rng = random.Random(2)
    some = [(rng.randint(-5, 5), rng.choice([-(2**62), -3, 0, 3, 2**62]), rng.random() < 0.5, rng.randint(-9, 2**61)) for _ in range(300)]
    keys = sorted(hard_negatives.key_of(*k) for k in some)
    assert [hard_negatives.parts_of(k) for k in keys] == sorted(some, key=lambda k: (k[0], -k[1], k[2], k[3]))


def test_products_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for size in (10, 2**24, 2**30):
        a, b = rng.integers(-size, size, (5, 4)), rng.integers(-size, size, (6, 4))
        assert hard_negatives.products(a, b).tolist() == (a.astype(object) @ b.astype(object).T).tolist()
    with pytest.raises(OverflowError):
        hard_negatives.products(np.full((1, 4), 2**40), np.full((1, 4), 2**40))


# --- near-duplicate embeddings


def duplicates_by_force(rows, threshold=0.93):
    good = [
        label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        for _, vector, label in rows
    ]
    unit = [np.array(r[1], np.float32).astype(float) if g else None for r, g in zip(rows, good)]
    linked = {i: {i} for i in range(len(rows))}
    met = Counter()
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] / math.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= threshold:
                    met.update([i, j])
                    whole = linked[i] | linked[j]
                    for k in whole:
                        linked[k] = whole
    least = [min((rows[k][0] for k in linked[i] if rows[k][0] is not None), default=None) for i in range(len(rows))]
    return Counter((r[0], met[i], least[i], r[0] == least[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize("noise", [0.0, 0.1, 0.25, 1.0])
def test_near_duplicates(vectors_of, monkeypatch, noise):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 30)
    monkeypatch.setattr(embedding_dedup, "FIRST_AXES", 2)
    rows = rows_around(5, 250, 6, noise, dims=12) + BAD + [(950 + i, [1.0, 2.0 + i], 1) for i in range(4)]
    rows += [(7, [3.0, 4.0], 1), (None, [3.0, 4.0], 1), (990, [1e-38] * 3, 0), (991, [3e38] * 3, 0)]
    got = embedding_dedup.near_duplicates(vectors_of(rows)).collect()
    assert Counter(map(tuple, got)) == duplicates_by_force(rows)


def test_a_chain_across_blocks_is_one_component(vectors_of, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 10)
    angles = [0.3 * i for i in range(20)]  # neighbours have a cosine of 0.955
    rows = [(50 - i, [math.cos(a), math.sin(a)], 1) for i, a in enumerate(angles)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors_of(rows)).collect()}
    assert {r.component_id for r in got.values()} == {31} and [i for i, r in got.items() if r.kept] == [31]
    assert Counter(map(tuple, got.values())) == duplicates_by_force(rows)


def test_nothing_to_compare(vectors_of):
    assert embedding_dedup.near_duplicates(vectors_of([])).collect() == []
    got = embedding_dedup.near_duplicates(vectors_of(BAD)).collect()
    assert Counter(map(tuple, got)) == duplicates_by_force(BAD)


@pytest.mark.parametrize("turned", [True, False])
def test_tiles_stop_early_and_lose_nothing(turned):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 40))
    left, right = (centres[rng.integers(5, size=n)] + rng.normal(size=(n, 40)) * 0.24 for n in (70, 50))
    axes = np.linalg.qr(rng.normal(size=(40, 40)))[0] if turned else None
    got = {(int(a), int(b)) for at, of in embedding_dedup.close_pairs(left, right, axes, 0.93, False) for a, b in zip(at, of)}
    unit = [x / np.linalg.norm(x, axis=1)[:, None] for x in (left, right)]
    want = set(zip(*(x.tolist() for x in np.nonzero(unit[0] @ unit[1].T >= 0.93))))
    assert got == want and 0 < len(want) < 3500


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked_by_force(docs, items, top):
    terms = [TERM.findall((r[1] or "").translate(SMALL)) for r in docs]
    n, words = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for found in terms for t in set(found))
    out = Counter()
    for item_id, text in {(i[0], i[1] or "") for i in items}:
        asked, scored = set(TERM.findall(text.translate(SMALL))), []
        for row, found in zip(docs, terms):
            if found:
                m, tf = 100 - 50 + (50 * len(found) * n) // words, Counter(found)
                score = sum(
                    math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in asked
                    if t in tf
                )
                if score > 0:
                    scored.append((-score, row[0] is None, row[0] or 0, row[0]))
        out.update((item_id, nth, s[3], -s[0]) for nth, s in enumerate(sorted(scored)[:top], 1))
    return out


def searched(seed):
    docs = [(i, prose(seed + i % 40, 5 + 7 * (i % 23)) + (" Été ÉTÉ été Ab_ab" if i % 3 else ""), "en", "a") for i in range(200)]
    items = [(i, prose(seed + i, 12 + i), "q", "t") for i in range(12)]
    items += [(50, "ab Été AB", "q", "t"), (51, None, "q", "t"), (52, " - ", "q", "t"), (None, "ab", "q", "t"), (53, "absent", "q", "t")]
    return docs, items + [items[0], (1, "other oak1 words", "q", "t")]


@pytest.mark.parametrize("passes", [1, 4])
def test_ranked_search(spark, docs_of, odd_rows, monkeypatch, passes):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 60)
    monkeypatch.setattr(ranked_search, "LEAF", 8)
    monkeypatch.setattr(ranked_search, "TERMS_A_PASS", 80 if passes > 1 else 10**6)
    docs, items = searched(10)
    docs = docs + odd_rows
    got = ranked_search.ranked(docs_of(docs), spark.createDataFrame(items, ITEMS), top=7).collect()
    assert Counter(map(tuple, got)) == ranked_by_force(docs, items, 7) and len(got) > 60


def test_search_of_nothing(spark, docs_of):
    docs, items = searched(10)
    assert ranked_search.ranked(docs_of([]), spark.createDataFrame(items, ITEMS)).collect() == []
    assert ranked_search.ranked(docs_of([(1, None), (2, " .")]), spark.createDataFrame(items, ITEMS)).collect() == []
    assert ranked_search.ranked(docs_of(docs), spark.createDataFrame([], ITEMS)).collect() == []


def test_trees_pass_over_leaves_and_lose_nothing():
    """Documents in clusters: a query about one of them opens few leaves, and always finds the best."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 30) for i in range(900)]
    starts = np.r_[0, np.cumsum([len(r) for r in rows])]
    terms, values = np.concatenate(rows), rng.integers(1, 10**6, starts[-1])
    tree = ranked_search.BallTree(starts, terms, values, 600, leaf=10)
    full = np.zeros((900, 600), dtype=np.int64)
    for i, r in enumerate(rows):
        full[i, r] = values[starts[i] : starts[i + 1]]
    ids, leaves, opened = rng.permutation(900), sum(c is None for c in tree.children), []
    for cluster in range(30):
        query = np.sort(rng.choice(20, 6, replace=False)) + 20 * cluster
        weights = rng.integers(0, 20_000, len(query))
        at, score, n = tree.best(query, weights, ids, 5)
        exact = full[:, query] @ weights
        best = [i for i in np.lexsort((ids, -exact))[:5] if exact[i] > 0]
        assert sorted(at.tolist()) == sorted(best) and sorted(score.tolist()) == sorted(exact[best].tolist())
        opened.append(n)
        bound = tree.bounds(query, weights)
        assert all(exact[tree.order[a:b]].max() <= bound[k] for k, (a, b) in enumerate(tree.spans))
    assert np.mean(opened) < leaves / 4
