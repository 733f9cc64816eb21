import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from assayer.llm.repeats import anchors, find_repeats, gram_length, remove_repeats
from tests.llm.conftest import SF_DIR, found

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def plain(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(gone.astype(int)) == -1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def noisy(rng, alphabet, n, passages):
    text = ""
    while len(text) < n:
        if rng.random() < 0.3:
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randrange(5, len(p))]
        else:
            text += "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30)))
    return text


@pytest.mark.parametrize("length", [20, 50, 200])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh é", "a"])
def test_brute_force_on_passages(documents, length, alphabet):
    rng = random.Random(length)
    passages = ["".join(rng.choice(alphabet) for _ in range(3 * length)) for _ in range(6)]
    rows = [(i, noisy(rng, alphabet, rng.randrange(10, 8 * length), passages)) for i in range(60)]
    # Near copies, exact copies and a repeated row.
    rows += [(100 + i, t[: len(t) // 2] + "#" + t[len(t) // 2 :]) for i, t in rows[:10]]
    rows += [(200, rows[3][1]), (201, rows[3][1]), rows[5], (None, rows[7][1]), (300, None), (301, "")]
    assert found(find_repeats(documents(rows), length), *COLUMNS) == plain(rows, length)


def test_all_documents_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert found(find_repeats(docs), *COLUMNS) == plain(rows, 200)


def test_every_string_has_one_anchor():
    text = random.Random(4).randbytes(300_000)
    begins = []
    for first, last, anchor, _ in anchors(text):
        assert (anchor >= last).all() and (anchor + gram_length(200) <= first + 200).all()
        begins += [k for a, b in zip(first, last) for k in range(a, b + 1)]
    assert begins == list(range(len(text) - 199))


def test_empty_table(documents):
    assert find_repeats(documents([])).collect() == []


def test_texts_without_repeats(documents):
    same = "0123456789" * 40 + "x"
    rows = [(1, "é" * 150 + "abc"), (2, None), (3, "short"), (4, same + "abc"), (5, "zz" + same)]
    got = {r["doc_id"]: r for r in remove_repeats(documents(rows), 200, ("source",)).collect()}
    assert got[2]["text"] is None and got[3]["text"] == "short"
    assert got[4]["text"] == "abc" and got[5]["text"] == "zz"
    assert "é" not in got[1]["text"] and got[1]["text"].endswith("abc")
