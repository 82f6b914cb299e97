"""The stages, one by one against brute force, and the whole run."""

import re
from collections import Counter

import corpus_pipeline
from llm_texts import prose
from test_large_operators import near_copies, places, similar_by_force
from test_small_operators import SEPARATORS, base_counts, passages_to_cut, sentences, separated, squeezed

from stockyard.llm import bpe, line_dedup


def test_stages(spark, docs_of, odd_rows, tmp_path):
    passage = sentences(900, 60)
    rows = odd_rows + [(100 + i, t, "en", "s") for i, t in enumerate(near_copies(3, 10, 150, 1))]
    rows += [(200 + i, f"{prose(500 + i, 40)}\n{passage}", "en", "s") for i in range(5)] + [(300, "spam " * 50, "en", "s")]
    rows += [(400 + 10 * i + k, f"{text}\n{prose(700 + 10 * i + k, 40)}", "en", "s") for i, c in enumerate(SEPARATORS) for k, text in enumerate(separated(c))]
    docs = docs_of(rows)
    columns = docs.columns
    seen = [rows]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(path := str(tmp_path / str(number)))
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == columns, name
            seen.append([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    start, quality, exact, near, cut = seen
    failed = [n < 20 or 100 * repeated > 30 * n for n, *_, repeated in (base_counts(r[1] or "") for r in start)]
    assert Counter(quality) == Counter(r for r, bad in zip(start, failed) if not bad)
    assert Counter(squeezed(r[1]) for r in exact) == Counter({squeezed(r[1]) for r in quality})
    classes = similar_by_force(exact)
    assert Counter(r[0] for r in near) == Counter({c for _, c, _ in classes})
    gone = {r[0]: r for r in passages_to_cut(near, line_dedup.PARAGRAPH, line_dedup.MARKED)}
    texts = {r[0]: r[1] if r[0] not in gone else r[1][: gone[r[0]][1]] + r[1][sum(gone[r[0]][1:3]) :] for r in near}
    assert {r[0]: r[1] for r in cut} == texts and len(cut) == len(near) and set(gone) == {201, 202, 203, 204}
    packed = docs.collect()
    places(packed)
    coder = bpe.load(bpe.vocabulary_path())
    tokens = Counter()
    for p in packed:
        tokens[p.doc_id] += p.length
    assert tokens == Counter({r[0]: len(coder.encode(r[1])) // 4 + 1 for r in cut})


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    rows = out.collect()
    places(rows)
    documents = spark.read.parquet(f"{small}/documents.parquet")
    assert len({r.doc_id for r in rows}) > 0.8 * documents.count()
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert all(re.fullmatch(r"[a-zA-Z -]+", name) for name, _ in corpus_pipeline.STAGES)


def test_nothing(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == []
