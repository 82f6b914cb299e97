"""Url filters, exact dedup, line dedup and quality rules against brute force and on odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import difference, duckdb_rows, open_duckdb, spark_rows
from llm_texts import prose
from pyspark.sql import functions as F
from test_large_operators import near_copies

from stockyard.llm import common, entries, exact_dedup, line_dedup, quality_rules, url_filters
from stockyard.llm.shingles import WordHashes, window_hashes

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


@pytest.mark.parametrize("name", sorted(entries.ORACLE_SQL))
def test_sql(spark, small, name):
    assert difference(duckdb_rows(open_duckdb(small), entries.ORACLE_SQL[name]), spark_rows(entries.QUERIES[name](spark, small))) is None


# --- url filters

URLS = [
    "http://www.example.com/en/x", "http://example.com/en/x", "https://EXAMPLE.com/EN/x", "http://a.b.example.com/en/", "http://example.com",
    "http://example.com/?q=/en/", "x.net/es/", "http://x.net/es/1", "http://net/fr/", "http://x.net/", "ftp://notexample.com/en/1", "", None, "://",
    "http://com/", "http://.com/a", "http://a..com/b#c", "http://com./x", "http://xcom/y", "http://x.org/en/", "http://x.net#/es/", "a://b://net/es/",
]


def judge(url, rules=url_filters.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


MANY = [("allow" if i % 3 else "block", ".".join(["c", "b", "a", "com"][-d:]), p) for i, (d, p) in enumerate((d, p) for d in range(1, 5) for p in ("/", "/x", "/x/y"))]


@pytest.mark.parametrize("rules", [list(url_filters.RULES), MANY, []])
def test_urls(spark, rules):
    urls = URLS + [f"http://{h}{p}" for h in ("com", "a.com", "b.a.com", "c.b.a.com", "d.c.b.a.com", "z.a.com", "aa.com") for p in ("", "/", "/x", "/x/yz", "/y")]
    pages = spark.createDataFrame([(i % 30, u, "allow", "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string, host string")
    got = url_filters.filter_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    want = Counter((i % 30, *judge(u, rules)) for i, u in enumerate(urls))
    assert Counter(map(tuple, got)) == want


def test_no_urls(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.filter_urls(pages, url_filters.rule_frame(spark)).collect() == []


# --- exact dedup


def squeezed(text):
    return "".join(c for c in text or "" if c not in BLANK)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (5, 7), (2, 2)])
def test_exact(docs_of, odd_rows, primes):
    """With tiny primes fingerprints collide: the comparison must still part the texts."""
    rows = odd_rows + [(100 + i, f"{i % 10} {'a' * (i % 3)}") for i in range(40)]
    docs = docs_of(rows)
    got = exact_dedup.exact_duplicates(docs, primes).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[squeezed(r[1])].append((-len(r[1] or ""), r[0] is None, r[0] or 0))
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        group = groups[squeezed(r[1])]
        want[(r[0], None if min(group)[1] else min(group)[2], len(group), hashlib.sha256(squeezed(r[1]).encode()).hexdigest())] += 1
    assert Counter((g.doc_id, g.keep_id, g.group_size, g.text_sha256) for g in got) == want
    kept = Counter(g.text_sha256 for g in got if g.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(g.doc_id == g.keep_id for g in got if g.kept)


def test_fingerprints_compose():
    text = prose(3, 5000).encode()
    for chunk in (16, 64, 4096):
        whole = exact_dedup.fingerprints([text, b"", b"a"], chunk=chunk)
        for column, (base, prime) in enumerate(zip(exact_dedup.BASES, exact_dedup.PRIMES)):
            value = 0
            for byte in text:
                value = (value * base + byte) % prime
            assert whole[0, column] == value
        assert whole[1].tolist() == [0, 0] and whole[2].tolist() == [97, 97]


def test_exact_documents(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = exact_dedup.kept_documents(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len({squeezed(r[1]) for r in odd_rows})
    assert exact_dedup.kept_documents(docs_of([])).collect() == []


# --- line dedup


def passages_to_cut(rows, least, marked):
    """The definition, paragraph by paragraph, with whole texts in place of digests."""
    first, found = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text, *_ in order:
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
        lower = [text[a:b].lower() for a, b in words]
        for a in range(len(words) - least + 1):
            key = tuple(lower[a : a + least])
            first.setdefault(key, (doc_id, a, a + least))
            found.append((doc_id, text, a, key, words))
    out = []
    marks = defaultdict(set)
    for doc_id, text, a, key, words in found:
        f = first[key]
        if doc_id != f[0] or a >= f[2]:
            marks[(doc_id, text)].add((a, a + least, words[a][0], words[a + least - 1][1], f[0]))
    for (doc_id, _), spans in marks.items():
        now = None
        for a, b, start, stop, kept in sorted(spans, key=lambda x: x[:2]):
            if now and a <= now[1]:
                now[1], now[3] = max(now[1], b), max(now[3], stop)
            else:
                now = [a, b, start, stop, kept, doc_id]
                out.append(now)
    return [(doc_id, start, stop - start, b - a, kept) for a, b, start, stop, kept, doc_id in out if b - a >= marked]


def sentences(seed, n):
    """Sentences of five to fifteen words."""
    words, rng, out = prose(seed, n).split(), random.Random(seed), []
    while words:
        size = rng.randint(5, 15)
        out.append(" ".join(words[:size]).capitalize() + rng.choice(".!?"))
        words = words[size:]
    return " ".join(out)


def test_passages(docs_of, odd_rows):
    passage, other = sentences(4, 70), sentences(5, 60)
    rows = odd_rows + [
        (20, f"{sentences(6, 40)}\n{passage}\nshort"),
        (21, f"head é {passage} tail goes on. {sentences(7, 30)}"),  # in the middle of a line
        (22, f"{prose(8, 9)} {passage.upper().lower().capitalize()}\n{other}"),
        (23, other), (23, other), (24, f"{passage}\n{passage}"), (None, f"x {passage}"), (25, sentences(4, 24)),
        (26, ("spam " * 80).strip()), (27, "SHOUT! " * 80),
    ]
    docs = docs_of(rows)
    got = line_dedup.repeated_units(docs)
    assert Counter(map(tuple, got.collect())) == Counter(set(passages_to_cut(rows, line_dedup.PARAGRAPH, line_dedup.MARKED)))
    texts = {r.doc_id: r for r in line_dedup.kept_documents(docs).collect()}
    assert line_dedup.kept_documents(docs).columns == docs.columns and line_dedup.kept_documents(docs).count() == len(rows)
    assert texts[20].text == rows[len(odd_rows)][1]
    for doc_id in (21, 24):  # of 70 words less than a unit is left
        left = texts[doc_id].text
        assert passage[:200] not in left and texts[doc_id].n_chars == len(left)
    assert texts[21].text.startswith("head é ") and texts[21].text.endswith(sentences(7, 30))
    assert texts[6].text == "" and other[:200] not in texts[23].text and len(texts[23].text) < 100
    assert line_dedup.repeated_units(docs_of([])).collect() == [] and line_dedup.kept_documents(docs_of([])).collect() == []


def test_inline_passages_are_found_wherever_they_stand(docs_of):
    passage = sentences(40, 60)
    rows = [(i, f"{prose(50 + i, 7 + i)} {passage} {sentences(80 + i, 40)}") for i in range(12)]
    got = {r.doc_id: r for r in line_dedup.repeated_units(docs_of(rows)).collect()}
    assert set(got) == set(range(1, 12))
    for i, r in got.items():
        assert rows[i][1].find(passage) <= r.start + 1 and r.n_words >= 45 and r.kept_doc_id == 0


def test_passages_without_marks_are_found_to_their_ends(docs_of):
    """Lower case, no punctuation, 51 to 60 words at any offset, also in a script without capitals."""
    rng, rows, want = random.Random(5), [], {}
    for k in range(60):
        passage = prose(2000 + k, 51 + k % 10)
        passage = "".join(chr(0x905 + ord(c) % 48) if c != " " else c for c in passage) if k % 3 == 0 else passage
        for half in range(2):
            head, tail = (prose(3000 + 4 * k + 2 * half + i, rng.randint(0, 40)) for i in range(2))
            rows.append((2 * k + half, " ".join(x for x in (head, passage, tail) if x)))
        want[2 * k + 1] = (rows[-1][1].index(passage), len(passage), len(passage.split()), 2 * k)
    got = line_dedup.repeated_units(docs_of(rows)).collect()
    assert {g.doc_id: (g.start, g.length, g.n_words, g.kept_doc_id) for g in got} == want and len(got) == 60


def test_clashing_ids_cut_nothing_beyond_a_text(docs_of):
    spans = docs_of([]).sparkSession.createDataFrame([(1, 5, 3), (1, 20, 4), (2, 0, 2)], "doc_id long, start long, length long")
    got = line_dedup.without_spans(docs_of([(1, "0123456789"), (1, "0123"), (2, "ab"), (3, None), (2, None)]), spans).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(1, "0123489"), (1, "0123"), (2, ""), (3, None), (2, None)])


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_are_told_apart(docs_of, doc_id):
    passage = sentences(60, 70)
    rows = [(doc_id, f"{passage} {sentences(61 + i, 40)}") for i in range(4)] + [(doc_id, sentences(70, 150)), (doc_id, f"{sentences(71, 30)}\n{passage}")]
    left = [r.text for r in line_dedup.kept_documents(docs_of(rows)).collect()]
    assert sum(passage in t for t in left) == 1 and sum(passage[100:200] in t for t in left) == 1
    assert sentences(70, 150) in left and all(any(sentences(61 + i, 40)[100:] in t for t in left) for i in range(4))
    got = line_dedup.repeated_units(docs_of(rows)).collect()
    assert len(got) == 4 and all(g.kept_doc_id == doc_id for g in got)


# --- quality rules


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    twice = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(twice)


def test_base_counts(docs_of, odd_rows):
    rows = odd_rows + [(30, "a b c\na b c\n\n \na b c "), (31, "x " * 25), (32, prose(6, 9) + " " + prose(6, 9) + " tail"), (33, "\x1c\x85a\xa0b")]
    got = quality_rules.judged(docs_of(rows))[0].collect()
    want = Counter((r[0], *base_counts(r[1] or "")) for r in rows)
    assert Counter((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) for g in got) == want
    for g in got:
        assert g.base_failed == (g.n_words < 20 or 100 * g.n_repeat_words > 30 * g.n_words)
        assert g.kept == (not g.base_failed)
    assert quality_rules.judged(docs_of([]))[0].collect() == []


SEPARATORS = "\x1c\x1d\x1e\x1f"


def separated(c):
    """The separator inside a word, alone on a line and at both ends of one."""
    return [f"fine words here and there\na{c}b c", f"{c}\n{c}\nx", f"{c}start and end{c}\n{c}start and end{c}\n{c} {c}{c} x", f"é{c}\n{c}é {c}", c]


def test_separators_are_parts_of_words(docs_of):
    rows = [(10 * i + k, text, "en", "s") for i, c in enumerate(SEPARATORS) for k, text in enumerate(separated(c))]
    got = quality_rules.judged(docs_of(rows))[0].collect()
    want = Counter((r[0], *base_counts(r[1])) for r in rows)
    assert Counter((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) for g in got) == want
    assert {g.n_dup_lines for g in got if g.doc_id % 10 in (1, 2)} == {1}
    notice = "kept\x1cby the owner of this site until further notice is given to all of its readers"
    rows = [(i, f"{notice}\n{prose(100 + i, 60)}", "en", "s") for i in range(30)]
    verdicts, removed = quality_rules.judged(docs_of(rows))
    assert all(v.kept and v.n_removed_words == 16 for v in verdicts.collect()) and removed.count() == 30


def test_boilerplate_goes_and_copies_stay(docs_of):
    notice = "all rights in this page and in whatever it links to are reserved by the owner of the site until further notice"
    copy = prose(7, 80)
    rows = [(i, f"{notice}\n{prose(100 + i, 60)}", "en", "s") for i in range(30)]
    rows += [(50 + i, f"{notice.upper()}\n{prose(200 + i, 5)}", "en", "s") for i in range(3)]  # depleted
    rows += [(100 + i, f"{copy}\n{prose(8, 40)}", "en", "s") for i in range(40)]  # copies of one document
    rows += [(200 + i, f"{notice}\n{prose(300 + i, 60)}", "en", "t") for i in range(5)]  # rare on this host
    verdicts, removed = quality_rules.judged(docs_of(rows), min_docs=10, share=0.01)
    got = {v.doc_id: v for v in verdicts.collect()}
    assert all(got[i].kept and got[i].n_removed_words == 22 for i in range(30))
    assert not any(got[50 + i].kept or got[50 + i].base_failed for i in range(3))
    assert all(got[100 + i].kept and not got[100 + i].n_removed_words for i in range(40))
    assert all(got[200 + i].kept and not got[200 + i].n_removed_words for i in range(5))
    assert {(r.doc_id, r.unit) for r in removed.collect()} == {(i, 0) for i in [*range(30), 50, 51, 52]}
    texts = {r.doc_id: r.text for r in quality_rules.kept_documents(docs_of(rows)).collect()}
    assert texts[3] == prose(103, 60) and texts[203].startswith(notice) and set(texts) == set(got) - {50, 51, 52}


def lined(words, size=10):
    words = words.split()
    return "\n".join(" ".join(words[i : i + size]) for i in range(0, len(words), size))


def test_sketches_equal_brute_force():
    rng = random.Random(9)
    for _ in range(20):
        lines = [prose(rng.random(), rng.randint(1, 12)).split() for _ in range(rng.randint(0, 8))]
        hashed = WordHashes().of([w for line in lines for w in line])
        got = quality_rules.sketches(hashed, np.array([len(line) for line in lines], dtype=np.int64))
        assert got.tolist() == [int(window_hashes(WordHashes().of(line), min(5, len(line))).min()) for line in lines]


def test_large_blocks_are_boilerplate(docs_of):
    rows = []
    for part in (75, 80, 90, 95):  # percent of the words
        block = lined(prose(part, 2 * part))
        rows += [(1000 * part + i, f"{block}\n{lined(prose(1000 * part + i, 200 - 2 * part))}", "en", f"s{part}") for i in range(30)]
    verdicts, _ = quality_rules.judged(docs_of(rows))
    got = verdicts.collect()
    assert len(got) == 120 and not any(g.kept or g.base_failed for g in got)


def test_copies_count_once(docs_of):
    notice = prose(1, 15)
    rows = [(i, f"{notice}\n{lined(prose(100 + i, 60))}", "en", "s") for i in range(20)]
    rows += [(100 + i, f"{notice}\n{lined(prose(7, 60))}", "en", "s") for i in range(45)]
    rows += [(200 + i, lined(t, 30), "en", "s") for i, t in enumerate(near_copies(3, 40, 300, 1))]
    rows += [(300 + i, lined(prose(8, 60)), "en", "s") for i in range(40)] + [(400, f"{lined(prose(8, 60))}\n{lined(prose(9, 60))}", "en", "s")]
    verdicts, removed = quality_rules.judged(docs_of(rows))
    assert {(r.doc_id, r.unit) for r in removed.collect()} == {(i, 0) for i in [*range(20), *range(100, 145)]}
    assert all(v.kept for v in verdicts.collect())


# --- helpers


def test_streamed_groups():
    import pandas as pd

    frame = pd.DataFrame({"k": [1, 1, 2, 3, 3, 3, 4], "v": range(7)})
    for size in (1, 2, 3, 7):
        parts = [frame.iloc[i : i + size] for i in range(0, 7, size)]
        groups = list(common.streamed_groups(iter(parts), ["k"]))
        assert [g["v"].tolist() for g in groups] == [[0, 1], [2], [3, 4, 5], [6]]


def test_without_keeps_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    gone = docs.select("doc_id", F.xxhash64(common.text_of(docs)).alias("text_hash")).filter("doc_id is null or doc_id = 1")
    out = common.without(docs, gone)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {2, 3, 4, 5, 6, 7, 8, 9, 10}
