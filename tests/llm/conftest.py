import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_texts import prose  # noqa: E402

SMALL = "/root/testdata/sf0.001"
#: Columns of documents and others whose names operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, text_hash string, kept string, host string, "
    "mark string, digest string, cut string, best string, h int, s1 string, _id string, `odd name.` string"
)


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text[, lang[, source]]) rows, with columns of clashing names."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None, *["x"] * 8, 1, *["y"] * 3) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, a very long text, ties, repeated rows, copies."""
    long = prose(1, 60_000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (None, None, None, None),
        (None, "", "en", "a"),
        (1, base, "en", "a"),
        (1, base, "en", "a"),
        (2, " " + base.replace(" ", "\t") + "\n", "en", None),
        (3, " ".join(near), "en", "b"),
        (4, long, "en", "b"),
        (5, long + " end", "en", "b"),
        (6, "", None, "a"),
        (7, " \n\t ", "xx", "a"),
        (8, "!!! ### 123", None, "a"),
        (9, "Ünïcode 字 \U0001f600 é", "en", "a"),
        (10, base, None, "c"),
    ]
