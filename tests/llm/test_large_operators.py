"""Joins, tokens, models, pages and packing against brute force and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from stockyard.llm import bpe, common, entries, html_extraction, language_id, library_bpe, ngram_join, packing, quality_classifier
from stockyard.llm.components import components

tokenizers = pytest.importorskip("tokenizers")

# --- components


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (2, 1)] + [(i, i + 1) for i in range(100, 140)] + [(1000, i) for i in range(1001, 1040)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {i: 100 for i in range(100, 141)} | {i: 1000 for i in range(1000, 1040)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- n-gram Jaccard join


def similar_by_force(rows, threshold=0.8):
    sets = []
    for _, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    links = [
        {j for j, b in enumerate(sets) if j != i and a and b and len(a & b) * (1 + threshold) >= threshold * (len(a) + len(b)) - 1e-9}
        for i, a in enumerate(sets)
    ]
    least, out = lambda r: (r[0] is None, r[0] or 0), []
    for i, row in enumerate(rows):
        seen, todo = set(), [i]
        while todo:
            if (x := todo.pop()) not in seen:
                seen.add(x)
                todo += links[x]
        out.append((row[0], min((rows[x] for x in seen), key=least)[0], len(links[i])))
    return Counter(out)


def near_copies(seed, copies, words, changes):
    base = prose(seed, words).split()
    for i in range(copies):
        own = list(base)
        for k in range(changes):
            own[(7 * i + 31 * k) % words] = f"change{seed}x{i}x{k}"
        yield " ".join(own)


@pytest.mark.parametrize("bucket,block", [(384, 384), (4, 4), (2, 1)])
def test_similar(docs_of, odd_rows, bucket, block):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(near_copies(1, 25, 150, 1))] + [(200 + i, t) for i, t in enumerate(near_copies(2, 12, 90, 2))]
    shared = prose(50, 12)
    rows += [(300 + i, f"{shared} {prose(400 + i, 30)}") for i in range(20)] + [(400, "one two"), (401, "One  two"), (402, "one")]
    got = ngram_join.similar(docs_of(rows), recall=0.99999, bucket=bucket, block=block)
    assert Counter((g.doc_id, g.class_id, g.n_links) for g in got.collect()) == similar_by_force(rows)


def test_similar_on_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = similar_by_force([(r.doc_id, r.text) for r in docs.collect()])
    got = Counter(map(tuple, entries.op1_ngram_jaccard_join(spark, small).select("doc_id", "class_id", "n_links").collect()))
    assert sum((want & got).values()) >= 0.999 * sum(want.values())


def test_one_of_each_class_stays(docs_of, odd_rows):
    docs = docs_of(odd_rows + [(100 + i, t) for i, t in enumerate(near_copies(1, 25, 150, 1))])
    out = ngram_join.kept_documents(docs)
    assert out.columns == docs.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids == Counter({None: 2, 1: 2, 4: 1, 6: 1, 7: 1, 8: 1, 9: 1, 100: 1})  # texts without words are each their own; row 1 is repeated
    assert ngram_join.similar(docs_of([])).collect() == []


def test_alone_after_a_split_counts_its_depth(spark):
    """At 0.8 a partner was kept with probability 0.64 or 0.512 only."""
    keys = {1: [1, 2, 3], 2: [1, 2, 4], 3: [1, 2, 5], 4: [1, 6, 7], 5: [1, 8, 9], 6: [1, 10, 11], 7: [12, 13, 14]}
    classes = spark.createDataFrame([(s, s, k * 9) for s, k in keys.items()], "s1 long, s2 long, keys array<long>")
    rows = ngram_join.final_buckets(classes, 9, 3, 2).collect()
    assert {(r.s1, r.depth, r.n) for r in rows} == {(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 2, 1), (5, 2, 1), (6, 2, 1)} and len(rows) == 54
    for s, depth in ((1, 3), (4, 2), (7, 1)):
        runs = ngram_join.most_runs(recall=0.999, depth=depth)
        met = [(r.run, r.bucket, r.depth, r.n) for r in rows if r.s1 == s and r.run < runs - 1] + [(runs - 1, 77, depth, 5)]
        assert ngram_join.used_runs(30, met, 0.8, 0.999) == [(runs - 1, 77, 5)]  # the last run that is needed is not left out


def test_recall_with_frequent_shingles(docs_of):
    """Templates split every bucket; pairs at the threshold are found all the same."""
    rows = []
    for i in range(300):
        own = f"{' '.join(prose(i % 3, 120).split()[:50])} {prose(1000 + i, 70)}".split()
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:60] + ["x"] + own[60:90] + ["y"] + own[90:]))]
    got = ngram_join.similar(docs_of(rows), bucket=8).collect()
    assert sum(g.n_links == 1 for g in got) >= 0.999 * len(rows) and all(g.class_id == g.doc_id // 2 * 2 for g in got if g.n_links)


# --- BPE

TEXTS = [
    "", "a<|endoftext|>B  <|startoftext|>x", "ΑΣ ΟΔΟΣ.", "İstanbul I'LL he'd don't 'tis", "é \x1c x\x1dy \x85 z\xa0w", "½ ² ١٢ 12345 ५", "日本語。",
    "<|EndOfText|>, <|endof", "ſ K Å ﬁ ẞ", "̈́ क़. Ω", "___---!!!?? ..., a.b. c.., d,,.!", "Ǆ ǅ ᾈ", " ́x", "\x00\x01 \x7f",
    "aaaaaaaaaaaaaaaaaaaaaaa " + "ab" * 3000, "\U0001f600\U0001f468‍\U0001f469‍\U0001f467", "\n\t ", "Words, and: more; words! end?",
]


def test_bpe_equals_the_library(spark, small, docs_of, odd_rows):
    library = tokenizers.Tokenizer.from_file(bpe.vocabulary_path())
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = odd_rows + [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(2000 + i, t) for i, t in table]
    got = Counter(map(tuple, bpe.digests(docs_of(rows)).collect()))
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        marks = (hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), decoded.encode()))
        want[(doc_id, len(ids), *marks)] += 1
    assert got == want
    assert bpe.digests(docs_of([])).collect() == []


def test_both_coders_agree():
    own, fast = bpe.load(bpe.vocabulary_path()), library_bpe.load(bpe.vocabulary_path())
    texts = TEXTS + [prose(i, 300) for i in range(5)]
    assert fast.encode_many(texts) == [own.encode(t) for t in texts] == [i for t in texts for i in fast.encode_many([t])]


def test_both_coders_cut_every_character_alike():
    """Each character alone, inside a word, doubled and beside digits; the library agrees."""
    own, fast = bpe.load(bpe.vocabulary_path()), library_bpe.load(bpe.vocabulary_path())
    points = [c for c in [*range(0x3000), *range(0x3000, 0x110000, 23)] if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"{chr(c)} a{chr(c)}b 1{chr(c)}{chr(c)}'s" for c in points[i : i + 50]) for i in range(0, len(points), 50)]
    assert fast.encode_many(texts) == [own.encode(t) for t in texts]
    assert fast.encode_many(["x  y", "", "x  y", " "]) == [own.encode(t) for t in ("x  y", "", "x  y", " ")]


def test_batches_hold_whole_texts():
    assert list(library_bpe.batches(["aa", "b", "cccc", "", "d"], 3)) == [["aa", "b"], ["cccc"], ["", "d"]]
    assert list(library_bpe.batches([], 3)) == []


def test_memory_is_bounded():
    known = library_bpe.Recent(10)
    for i in range(100):
        for key in known.absent({f"{i}", "always"}):
            known[key] = i
        assert known["always"] == 0 and len(known) <= 12


# --- packing


def places(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(bins)


def test_packing(docs_of, odd_rows):
    rows = odd_rows + [(100 + i, prose(i, 20 + 37 * i)) for i in range(40)] + [(None, None)] * 50 + [(5000, "")] * 50
    got = packing.packed_documents(docs_of(rows)).collect()
    coder = bpe.load(bpe.vocabulary_path())
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = coder.encode(text or "") + bytes(4)
        for piece, at in enumerate(range(0, len(ids), 8192)):
            want[(doc_id, piece, at // 4, len(ids[at : at + 8192]) // 4, zlib.crc32(ids[at : at + 8192]))] += 1
    assert Counter((g.doc_id, g.piece, g.start, g.length, g.ids_crc32) for g in got) == want
    bins = places(got)
    assert bins <= 1.05 * sum(g.length for g in got) / packing.CAPACITY + 1
    assert packing.packed_documents(docs_of([])).collect() == []


@pytest.mark.parametrize("capacity", [7, 10, 30, 100])
def test_plans(capacity):
    rng = np.random.default_rng(capacity)
    for _ in range(60):
        sizes = rng.integers(1, rng.integers(2, capacity + 2), rng.integers(1, 400)).clip(1, capacity)
        counts = Counter(sizes.tolist())
        plan = packing.Plan(counts, capacity)
        taken = set()
        for size, run in plan.lookup().items():
            rank = np.arange(counts[size])
            own = run[np.searchsorted(run[:, 0], rank, side="right") - 1]
            nth = rank - own[:, 0]
            for b, o in zip(own[:, 1] + nth // own[:, 2], own[:, 3] + nth % own[:, 2] * size):
                cells = {(int(b), int(o) + k) for k in range(size)}
                assert not cells & taken and o + size <= capacity
                taken |= cells
        assert len(taken) == sizes.sum() and {b for b, _ in taken} == set(range(plan.bins))
        fill = Counter(b for b, _ in taken)
        assert all((b, o) in taken for b, n in fill.items() for o in range(n))  # gapless
        large = sum(n for size, n in counts.items() if 2 * size > capacity)
        assert plan.bins <= max(large, 1.25 * sizes.sum() / capacity + 1) + sum(1 for s in counts if 3 * s > capacity)


# --- language


def test_costs_are_exact():
    sample = {"a": [prose(1, 80).encode(), b"abracadabra"], "b": ["été à la mer, ".encode() * 5]}
    model = language_id.Model(sample, 4).ready()
    texts = [b"", b"a", b"abra", b"\xff\x00\xff", prose(2, 40).encode(), "où est l'été".encode(), b"zz"]
    full = [t for t in texts if t]
    got = model.costs_of(np.frombuffer(b"".join(full), np.uint8), np.cumsum([0, *map(len, full[:-1])]))
    want = [[language_id.exact_cost(sample[lang], t, 4) for lang in model.langs] for t in full]
    assert np.abs(got - np.array(want)).max() < 1e-9


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    find = language_id.Lookup(keys)
    assert (find(keys) == np.arange(len(keys))).all()
    assert (find(keys + np.uint64(1)) == np.where(np.isin(keys + np.uint64(1), keys), np.searchsorted(keys, keys + np.uint64(1)), -1)).all()


def test_languages(spark, docs_of, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 300 and sum(g.lang_pred == g.lang for g in got) >= 0.98 * len(got)
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 3 == 1) and 0 <= g.score <= 1 for g in got)
    odd = language_id.identified(docs_of(odd_rows)).collect()
    assert len(odd) == len(odd_rows)
    assert all(o.lang_pred == "und" and o.score == 0 for o in odd if o.doc_id in (None, 6, 7, 8))
    assert all(o.lang_pred != "und" for o in odd if o.doc_id in (1, 5, 9))
    assert all(o.lang_pred == "und" for o in language_id.identified(docs_of([(1, "abc"), (2, None)])).collect())
    assert language_id.identified(docs_of([])).collect() == []


def test_languages_of_long_texts_are_learned(docs_of):
    rows = [(i, prose(i, 40), "en") for i in range(30)] + [(100 + i, "où est l'été à la mer " * (60 + i), "fr") for i in range(12)]
    docs = docs_of(rows)
    sample = language_id.training_sample(docs, size=4_000)
    assert set(sample) == {"en", "fr"} and all(3_900 <= sum(map(len, t)) <= 4_500 for t in sample.values())
    assert len(sample["fr"]) == 7 or len(sample["fr"]) == 8
    long = docs_of([(i, prose(i, 40), "en") for i in range(30)] + [(100 + i, "où est l'été à la mer " * 2_500, "fr") for i in range(9)])
    got = {r.doc_id: r.lang_pred for r in language_id.identified(long).collect()}
    assert all(got[i] == "en" for i in range(30)) and all(got[100 + i] == "fr" for i in range(9))


# --- quality classifier


def test_quality(spark, docs_of, odd_rows):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50 and sum(g.predicted == g.quality for g in got) >= 0.95 * len(got)
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) and 0 <= g.score <= 1 for g in got)
    marks = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (4, 7), (77, 0)], "doc_id long, quality int")
    for rows in (marks, marks.filter("doc_id = 1"), marks.limit(0)):
        odd = quality_classifier.scored(docs_of(odd_rows), rows).collect()
        assert len(odd) == len(odd_rows) and all(0 <= o.score <= 1 and o.predicted == (o.score >= 0.3) for o in odd)
    assert all(o.score == 0.5 for o in odd)
    assert quality_classifier.scored(docs_of([]), marks).collect() == []


def test_cosine_votes_equal_brute_force():
    rng = np.random.default_rng(5)
    vectors, labels = rng.random((60, quality_classifier.TERMS)).astype(np.float32), rng.integers(0, 2, 60)
    space = quality_classifier.Space(vectors, labels, 8)
    asked = rng.random((9, quality_classifier.TERMS)).astype(np.float32)
    got = space.scores(asked)
    for vector, score in zip(asked, got):
        point = (np.sqrt(vector) * space.weight) @ space.axes
        near = sorted(((float(point @ p) / np.linalg.norm(point), y) for p, y in zip(space.points, labels)), reverse=True)[: quality_classifier.NEIGHBOURS]
        weights = [max(c, 1e-6) ** quality_classifier.POWER for c, _ in near]
        assert abs(score - sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights)) < 1e-4


# --- pages


def page(article, menu="<li>Home</li>", foot="<p>Contact us</p>"):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul>{menu}</ul></nav>{article}<footer>{foot}</footer></body></html>"


def extract(spark, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    return {r.page_id: r for r in html_extraction.extracted(pages).collect()}


def test_pages(spark):
    blocks = "<h1>A &amp; B</h1><p><b>x\n  y</b><br>z<p>caf&eacute; &#x41;&#66;<!-- gone --></p><div class='advert'>buy</div><form><p>no</p></form>"
    rows = [
        (1, "http://h/1", page(f"<article>{blocks}<section class=\"user-comments\"><p>first!</p></section></article><p>aside</p>")),
        (2, "http://h/2", page("<main><p>a</p><aside>b</aside><script>'</main>'</script>c</main>")),
        (3, None, None), (4, "http://h/4", ""), (5, "http://h/5", "<p>plain"), (6, "no url", "a<b"), (7, "http://h/7", "<article><p>cut off<div cla"),
        (10, "http://h/10", "<article><a title=\"open>link</a> 1 < 2<p>x"),
        (8, "http://h/8", page("<article><p>&lt;b&gt; stays &am</p></article>")), (8, "http://h/8", page("<article><p>&lt;b&gt; stays &am</p></article>")),
    ]
    got = extract(spark, rows)
    assert got[1].text == "A & B\nx y z\ncafé AB" and got[1].n_chars == len(got[1].text)
    assert got[2].text == "a\nc" and got[3].text == got[4].text == "" and got[5].text == "plain"
    assert got[7].text == "cut off" and got[8].text == "<b> stays &am" and got[10].text == "link 1 < 2\nx"
    assert extract(spark, []) == {}


def texts_in(markup):
    return [text for mark, text in html_extraction.blocks_of(markup) if mark == html_extraction.IN]


@pytest.mark.parametrize("name", ["post no-sidebar", "post has-comments", "main share-price", "withoutNav", "entry-content", "list-2 row"])
def test_names_that_say_no_part_keep_it(name):
    assert texts_in(f'<article class="{name}"><p>a</p></article>') == ["a"]
    assert texts_in(f'<main><div id="{name}"><p>a</p></div></main>') == ["a"]


@pytest.mark.parametrize("name", ["site-footer", "cookie-notice-box", "shareButtons", "comments-area", "Ad", "x nav-menu", "sidebar_2"])
def test_names_of_parts_take_them_out(name):
    assert texts_in(f'<article><p>a</p><div class="{name}"><p>b</p></div><p>c</p></article>') == ["a", "c"]


def test_hidden_is_an_attribute_of_its_own():
    kept = ['style="overflow:hidden"', 'data-x="hiddenfruit"', "class='post-body'", 'aria-hidden="false"', 'title="class=ad"']
    assert [texts_in(f"<article><p {a}>a</p></article>") for a in kept] == [["a"]] * len(kept)
    gone = ["hidden", 'hidden=""', "aria-hidden=true", "ARIA-HIDDEN='true'", "role=navigation"]
    assert [texts_in(f"<article><div {a}>a</div><p>b</p></article>") for a in gone] == [["b"]] * len(gone)
    assert texts_in('<article><h1 class="entry-header">t</h1><p>a</p></article><article class="comment-body"><p>b</p></article>') == ["t", "a"]


def test_excluded_elements_end_with_their_parent():
    assert texts_in("<article><p>a</p><div><nav><ul><li>b</div><p>c</p></article><p>d</p>") == ["a", "c"]
    assert texts_in("<body><nav><ul><li>b</ul><article><p>c</p><aside>x</article><article><p>d</p></article>") == ["c", "d"]
    assert texts_in("<article><div class=ad><div>x</div>y</div>z<p class=ad>q<p>r</p></article>") == ["z", "r"]
    assert texts_in("<article><b><div class=ad></b>x</div>y</article>") == ["y"]


def test_repeats_decide_without_an_article(spark):
    notice = "this site uses small files to remember what you like best of all"
    rows = [(i, f"https://h.com/{i}", f"<div>{notice}</div><div>{prose(i, 20)} {notice}</div><p>short{i}</p>") for i in range(6)]
    rows.append((9, "https://other.com/1", f"<div>{notice}</div>"))
    got = extract(spark, rows)
    assert all(got[i].text == f"{prose(i, 20)}\nshort{i}" for i in range(6))
    assert got[9].text == notice and got[0].n_repeated == 2 * len(notice.split())


def texts_by_force(rows, long=8):
    """Open texts by the definition, with whole runs in place of hashes."""
    pages = [(r[0], r[1].split("/")[2], [t for _, t in html_extraction.blocks_of(r[2])], r[2]) for r in rows]
    where = defaultdict(set)
    for _, host, texts, content in pages:
        words = " ".join(texts).split(" ")
        for i in range(len(words) - long + 1):
            where[(host, *words[i : i + long])].add(content)
    out = {}
    for page_id, host, texts, _ in pages:
        words = " ".join(texts).split(" ")
        gone = [False] * len(words)
        for i in range(len(words) - long + 1):
            if len(where[(host, *words[i : i + long])]) > 1:
                gone[i : i + long] = [True] * long
        left, at = [], 0
        for text in texts:
            n = len(text.split(" "))
            left.append(" ".join(w for w, g in zip(words[at : at + n], gone[at : at + n]) if not g))
            at += n
        out[page_id] = "\n".join(t for t in left if t)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_equal_brute_force_whatever_the_partitions(spark, parts):
    rng = random.Random(3)
    phrases = [" ".join(rng.choice("abc") for _ in range(rng.randint(4, 14))) for _ in range(8)]
    rows = []
    for i in range(60):
        blocks = [rng.choice(phrases) if rng.random() < 0.6 else prose(i, rng.randint(1, 9)) for _ in range(rng.randint(1, 5))]
        rows.append((i, f"http://h{i % 3}/{i}", "".join(f"<p>{b}</p>" for b in blocks)))
    rows.append((100, "http://h0/copy", rows[0][2]))  # a copy makes nothing boilerplate
    rng.shuffle(rows)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    got = {r.page_id: r.text for r in html_extraction.extracted(pages).collect()}
    assert got == texts_by_force(rows) and got[100] == got[0]


def test_suffix_array_of_a_host(spark):
    rng = random.Random(5)
    words = {i: [rng.choice("abc") for _ in range(40)] + [f"w{i}"] for i in range(9)}
    rows = [(i, "h" if i < 6 else "k", i % 8, [" ".join(words[i % 8])]) for i in range(9)]  # the last has the html of the first
    blocks = spark.createDataFrame(rows, "row long, host string, content long, texts array<string>").repartition(3)
    known = html_extraction.WordHashes()
    expected = sorted({
        (host, tuple(map(int, known.of(words[c][at : at + 3]))), c) for _, host, c, _ in rows for at in range(len(words[c]) - 2)
    })
    array = html_extraction.suffix_array(blocks, 3)
    got = [(r.host, tuple(np.frombuffer(r.tokens, ">u8").tolist()), r.content) for r in array.collect()]
    assert got == expected
    held = defaultdict(set)
    for host, tokens, content in expected:
        held[host, tokens].add(content)
    lists = np.array([tokens for _, tokens, _ in got], dtype=np.uint64)
    shared = html_extraction.common_prefixes(np.array([host for host, _, _ in got], dtype=object), lists)
    pairs = zip(got, got[1:])
    assert shared.tolist() == [0, *(0 if a[0] != b[0] else next((n for n in range(3) if a[1][n] != b[1][n]), 3) for a, b in pairs)]
    runs = {(host, int(html_extraction.window_hashes(np.array(t, dtype=np.uint64), 3).astype(np.int64)[0])) for (host, t), on in held.items() if len(on) > 1}
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for rows_a_piece in ("2", "1000"):  # intervals that go on in the next piece, and whole ones
            spark.conf.set(size, rows_a_piece)
            assert {tuple(r) for r in html_extraction.intervals(array, 3).collect()} == runs and len(runs) > 20
    finally:
        spark.conf.set(size, before)


def test_repetition_decides_inside_articles(spark):
    notice = "you read this because people like you pay for our small newsroom every month"
    quoted = "to be or not to be that is the question asked here"
    rows = [(i, f"http://h/{i}", f"<article><p>{prose(i, 20)}</p><p>{notice}</p><p>thanks all</p></article>") for i in range(20)]
    rows += [(20 + i, f"http://h/{20 + i}", f"<article><p>{quoted}</p><p>{prose(50 + i, 20)}</p></article>") for i in range(12)]
    rows += [(50 + i, f"http://few/{i}", f"<article><p>{notice}</p></article><p>{i}</p>") for i in range(10)]
    rows += [(70 + i, "http://copies/", f"<article><p>{quoted}</p></article>") for i in range(40)]
    for parts in (1, 9):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        got = {r.page_id: r for r in html_extraction.extracted(pages).collect()}
        assert all(got[i].text == f"{prose(i, 20)}\nthanks all" and got[i].n_repeated == 14 for i in range(20))  # on 20 of 32 pages
        assert all(got[20 + i].text == f"{quoted}\n{prose(50 + i, 20)}" for i in range(12))  # on 12 of 32
        assert all(got[50 + i].text == notice for i in range(10)) and all(got[70 + i].text == quoted for i in range(40))


def test_runs_of_all_pages_are_found_whatever_their_markup(spark):
    rows = [(i, f"http://h/{i}", f"<nav>{prose(90, 9)}</nav><article><p>{prose(i, 20)}</p><p>{prose(80 + i % 2, 12)}</p></article>") for i in range(4)]
    rows += [(9, "http://h/copy", rows[0][2]), (10, "http://one/1", rows[0][2])]
    blocks = html_extraction.parsed(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {len(r.repeated) for r in html_extraction.repeated_runs(blocks).collect()} == {2 + 5}  # windows of 9 and of 12 words
    got = extract(spark, rows)
    assert [got[i].n_shared for i in (0, 1, 2, 3, 9, 10)] == [9 + 12] * 5 + [0]
    assert all(got[i].text == f"{prose(i, 20)}\n{prose(80 + i % 2, 12)}" and got[i].n_repeated == 0 for i in range(4))


def test_hot_hosts(spark):
    rows = [(i, "http://hot/", page(f"<article><p>{prose(i, 30)}</p></article>")) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extracted(pages).collect()}
    assert got == {i: prose(i, 30) for i in range(200)}


def test_saved_tables_are_shared(spark):
    df = spark.range(10).withColumn("u", F.expr("uuid()"))
    kept = common.saved(df)
    assert kept.collect() == kept.collect()
