import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayer.llm import periodic
from assayer.llm.periodic import describe_runs, find_runs, least_pair, runs_of_texts
from assayer.llm.queries import op13_periodic_runs, plant_period
from tests.llm.conftest import SF_DIR, found

NAMES = (
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
)


def plain_runs(words, exponent=4, length=6):
    """All maximal stretches of each period, smallest period first."""
    n, out, taken = len(words), [], set()
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(length, exponent * p) and (i, j + p) not in taken:
                taken.add((i, j + p))
                out.append((i, j + p - i, p))
            i = j
    return sorted(out)


def plain_row(doc_id, words):
    runs = plain_runs(words)
    dropped = {i for s, l, p in runs for i in range(s + p, s + l)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, best[1] * 1000 // best[2]) if best else (None,) * 4

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    listed = "".join(f"{s},{l},{p}\n" for s, l, p in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, sha(listed), sha(kept))


def plain_planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def words_of(text):
    return [w.encode() for w in text]


def test_least_pair():
    assert least_pair(4, 6) == 5 and least_pair(3, 2) == 2


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=40), max_size=5))
def test_two_words(texts):
    assert runs_of_texts([words_of(t) for t in texts], 4, 6) == [plain_runs(words_of(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.lists(st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 9)), max_size=4), max_size=4
    ),
    st.sampled_from([(4, 6), (3, 2), (3, 9), (5, 6)]),
)
def test_repeated_parts(parts, bounds):
    texts = [words_of("".join(part * times for part, times in text)) for text in parts]
    assert runs_of_texts(texts, *bounds) == [plain_runs(t, *bounds) for t in texts]


def test_long_texts():
    random.seed(3)
    noise = [b"%d" % random.randrange(50) for _ in range(3000)]
    texts = [[b"x"] * 30_000, noise[:700] * 5 + noise, [b"a", b"b", b"c"] * 4000 + [b"x"] * 2000, noise]
    long = runs_of_texts(texts, 4, 6)
    assert long[0] == [(0, 30_000, 1)] and long[2] == [(0, 12_000, 3), (12_000, 2000, 1)]
    assert long[1] == plain_runs(texts[1]) and long[3] == plain_runs(noise)


def test_groups_are_cut_between_texts(documents, monkeypatch):
    rows = [(i, "a b " * i + "c " * (i % 9)) for i in range(40)]
    wanted = found(find_runs(documents(rows)), "doc_id", "n_words", "runs", "collapsed")
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 16)
    sorts = [[len(t) for t in texts] for _, texts in periodic._groups(_batch(rows), None)]
    assert max(len(s) for s in sorts if sum(s) > 16) == 1
    assert wanted == sorted(
        ((i, len(t.split()), _structs(t), " ".join(_collapsed(t))) for i, t in rows), key=repr
    )


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist([{"doc_id": i, "text": t.encode()} for i, t in rows])


def _structs(text):
    return [tuple(r) for r in plain_runs(text.split())]


def _collapsed(text):
    words = text.split()
    dropped = {i for s, l, p in plain_runs(words) for i in range(s + p, s + l)}
    return [w for i, w in enumerate(words) if i not in dropped]


def test_odd_rows(documents):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "x " * 6), (5, "x " * 5), (6, "é ß " * 9), (7, "a b " * 4), (7, "a b " * 4),
        (None, "x " * 8), (8, "a b a b a b c a b a b a b a b"), (9, "A a " * 6), (10, "x\x0bx\x0cx\rx\tx x"),
        (11, "a a a a a a b b b b b b"),
    ]
    wanted = [plain_row(i, (t or "").encode().split()) for i, t in rows]
    assert found(describe_runs(find_runs(documents(rows))), *NAMES) == sorted(wanted, key=repr)


def test_ties_go_to_the_first_run(documents):
    row = describe_runs(find_runs(documents([(1, "a a a a a a b c b c b c b c b c b c")]))).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (2, 0, 6, 1, 6000)


def test_empty_table(documents):
    assert describe_runs(find_runs(documents([]))).collect() == []


def test_bounds_are_checked(documents):
    with pytest.raises(ValueError):
        find_runs(documents([]), exponent=2)


def test_query_by_brute_force(spark):
    got = found(op13_periodic_runs(spark, SF_DIR), *NAMES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r[0], plain_planted(r[0], (r[1] or "").encode().split())) for r in docs]
    assert got == sorted((plain_row(i, words) for i, words in rows), key=repr)
    assert sum(row[1] > 0 for row in got) > 5


def test_planting():
    for doc_id in [None, *range(300)]:
        for n in (0, 1, 2, 7, 50):
            words = [b"%d" % i for i in range(n)]
            assert plant_period(doc_id, words) == plain_planted(doc_id, words)


def test_ranks_hold_for_wide_numbers():
    numbers = np.arange(100) % 7
    suffixes = periodic.Suffixes(numbers, np.array([0, 50]))
    for at in range(1, 100):
        a, b = suffixes.order[at - 1], suffixes.order[at]
        end_a, end_b = (50 if a < 50 else 100), (50 if b < 50 else 100)
        shared = 0
        while end_a == end_b and max(a, b) + shared < end_a and numbers[a + shared] == numbers[b + shared]:
            shared += 1
        assert suffixes.common[at] == shared
