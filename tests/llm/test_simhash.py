import random

import pytest
import xxhash

from assayer.llm.components import components
from assayer.llm.frames import Workspace
from assayer.llm.simhash import BITS, fingerprint, links, near_duplicates
from tests.llm.conftest import SF_DIR, found


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(BITS) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def plain(rows):
    codes = {t: plain_fingerprint(t) for _, t in rows}
    distinct = sorted(set(codes.values()))
    near = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2]
    roots = plain_components(distinct, near)
    least = {}
    for i, t in rows:
        if i is not None:
            r = roots[codes[t]]
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{codes[t]:016x}", least.get(roots[codes[t]])) for i, t in rows), key=repr)


@pytest.mark.parametrize("text", ["", " \t", "a", "A b", "a b c", "a b c d", "é ß é ß é ß", "x " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_all_documents_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert found(near_duplicates(docs), "doc_id", "fingerprint", "component_id") == plain(rows)


def test_odd_rows(documents):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, None), (7, ""), (8, " \n"), (None, "a b c d"), (2, "q r s t u")]
    assert found(near_duplicates(documents(rows)), "doc_id", "fingerprint", "component_id") == plain(rows)


def test_empty_table(documents):
    assert near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_links_join_what_is_near(spark, bits):
    random.seed(bits)
    codes = {random.getrandbits(64) for _ in range(5)}
    for _ in range(300):  # chains and clouds of near codes
        codes.add(random.choice(sorted(codes)) ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)))
    signed = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    frame = spark.createDataFrame([(c,) for c in signed], "code long")
    got = components(links(frame, bits), Workspace(spark)).collect()
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits]
    wanted = plain_components({n for pair in near for n in pair}, near)
    assert {r["node"]: r["root"] for r in got} == wanted


def test_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "b long, a long")
    assert {r["root"] for r in components(chain, Workspace(spark)).collect()} == {0}


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([(1,)], "code long"), 3)
