import hashlib
import re

import pytest

from assayer.llm.decontamination import decontaminate, find_contamination
from assayer.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF_DIR, found

COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item"),
    (3, None),
    (4, "..."),
    (2, "short ITEM"),
    (None, "unnamed passage here"),
    (10, "one two three four five six seven eight nine ten other end"),
    (11, "a a a"),
]
DOCS = [
    (1, "x ONE two, three-four five six seven; eight nine TEN eleven y"),
    (2, "a short\nitem, and a short  item"),
    (3, None),
    (4, ""),
    (5, "one two three four five six seven eight nine"),
    (6, "unnamed passage here"),
    (6, "unnamed passage here"),
    (None, "A a a A é"),
    (7, "short é item"),
]


def split(text):
    lower = (text or "").encode().lower()
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, names = split(text), set(), set()
        for name, passage in items:
            wanted = split(passage)
            n = min(10, len(wanted))
            for k in range(len(wanted) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == wanted[k : k + n]:
                        hit.update(range(i, i + n))
                        names.add("" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("slice_bytes", [1 << 20, 60])
def test_brute_force(documents, items, slice_bytes):
    got = find_contamination(documents(DOCS), items(ITEMS), slice_bytes=slice_bytes)
    assert found(got, *COLUMNS) == plain(DOCS, ITEMS)


def test_spans_are_cut(documents, items):
    got = decontaminate(documents(DOCS), items(ITEMS), remove="spans")
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[1] == "x  y" and texts[2] == "a , and a " and texts[6] == "" and texts[5] == DOCS[4][1]
    kept = decontaminate(documents(DOCS), items(ITEMS))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 7]


def test_empty_tables(documents, items):
    assert find_contamination(documents([]), items(ITEMS)).collect() == []
    assert found(find_contamination(documents(DOCS), items([])), *COLUMNS) == plain(DOCS, [])


def test_sql(spark, duck):
    got = found(QUERIES["op6_decontamination"](spark, SF_DIR), *COLUMNS)
    wanted = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE['op6_decontamination']})").fetchall()
    assert got == sorted(wanted, key=repr) and any(r[-1] for r in got)
