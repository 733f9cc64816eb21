import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from assayer.llm.packing import Encoder, Schedule, pack, sequences
from assayer.llm.queries import byte_tokenizer
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(byte_tokenizer())


def check(pieces, texts, tokenizer, size=1024):
    """Every id in one piece, checksums right, sequences gapless, padding as promised."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    wanted = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts.items()}
    assert set(by_doc) == set(wanted)
    for i, ids in wanted.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            part = ids[at : at + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    lengths = []
    for number in range(len(by_sequence)):
        at = 0
        for p in sorted(by_sequence[number], key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        lengths.append(at)
    assert all(n == size or (n < size and n & (n - 1) == 0) for n in lengths)
    assert sum(n != size for n in lengths) <= 10
    return by_sequence


def test_all_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    texts = {r[0]: r[1] for r in docs.select("doc_id", "text").collect()}
    pieces = [r.asDict() for r in pack(docs, byte_tokenizer()).collect()]
    by_sequence = check(pieces, texts, tokenizer)
    # Each window has each source's share of all tokens, within the rounding that is carried on.
    total = Counter()
    for p in pieces:
        total[p["source"]] += p["length"]
    share = {s: n / sum(total.values()) for s, n in total.items()}
    full = [ps for ps in by_sequence.values() if sum(p["length"] for p in ps) == 1024][:-2]
    for ps in full:
        for source in share:
            assert abs(sum(p["length"] for p in ps if p["source"] == source) - 1024 * share[source]) < 3


def test_odd_rows(documents, tokenizer):
    rows = [(1, None, "en", None), (2, "", "en", "a"), (3, "x" * 5000, "en", "a"), (4, "tie", "en", "b"), (5, "tie", "en", "b")]
    pieces = [r.asDict() for r in pack(documents(rows), byte_tokenizer(), size=64).collect()]
    check(pieces, {r[0]: r[1] for r in rows}, tokenizer, 64)
    assert pack(documents([]), byte_tokenizer()).collect() == []
    twice = pack(documents([(1, "a b", "en", "s")] * 2), byte_tokenizer()).collect()
    assert sum(p["length"] for p in twice) == 2 * twice[0]["doc_tokens"]


def test_targets_and_assembly(documents, tokenizer):
    rows = [(i, "some words to pack " * 40, "en", "a" if i % 4 else "b") for i in range(24)]
    pieces = pack(documents(rows), byte_tokenizer(), size=128, targets={"a": 0.5, "b": 0.5}, with_ids=True).cache()
    got = pieces.collect()
    check([r.asDict() for r in got], {r[0]: r[1] for r in rows}, tokenizer, 128)
    first = Counter()
    for p in got:
        if p["sequence_id"] < 5:
            first[p["source"]] += p["length"]
    assert abs(first["a"] - first["b"]) <= 4
    joined = {r["sequence_id"]: r["ids"] for r in sequences(pieces).collect()}
    assert sum(map(len, joined.values())) == sum(p["length"] for p in got)
    assert all(joined[p["sequence_id"]][p["offset"] : p["offset"] + p["length"]] == p["ids"] for p in got)
    pieces.unpersist()


@pytest.mark.parametrize("seed", range(6))
def test_schedule_is_a_partition(seed):
    rng = random.Random(seed)
    totals = [rng.choice([0, 1, 5, 1000, 54321]) for _ in range(rng.randrange(1, 9))]
    weights = None if seed % 2 else [rng.choice([0, 0.1, 1, 30]) for _ in totals]
    schedule = Schedule(totals, weights, 64)
    bounds = schedule.bound(np.arange(schedule.windows + 1))
    assert bounds[0] == 0 and bounds[-1] == sum(totals)
    if totals and sum(totals):
        taken = schedule.taken(bounds)
        assert (np.diff(taken, axis=1) >= 0).all() and (taken.sum(axis=0) == bounds).all()
        assert taken[:, -1].tolist() == totals


def odd_texts():
    rng = random.Random(1)
    alphabets = ["ab ", "a \n\t", "ab'sé 1.", "x <|endoftext|>", "  \x1c\x85a　", "'sltremdv ", "日本한ไทयُ12٣ "]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(30))) for a in alphabets for _ in range(400)]
    texts += ["a<|endoftext|> b", "word\n <|endoftext|>  x", "  lead", "trail  ", " ", ""]
    every = (chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000)
    texts += [f"a{c}1 {c}b{c} {c}{c} 7{c}." for c in every]
    return texts + [" " * 5000 + "x", "\n" * 300_000 + "x", "x" * 200_000, "ab" * 100_000, "^" * 100_000, " " * 500_000 + "é"]


def test_encoder_equals_the_library(tokenizer):
    texts, encoder = odd_texts(), Encoder(byte_tokenizer())
    assert encoder.merging is not None
    wanted = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
    assert [t for t, a, b in zip(texts, got, wanted) if a != b] == []


def changed(change):
    parts = json.loads(byte_tokenizer())
    change(parts)
    return json.dumps(parts)


@pytest.mark.parametrize(
    "change",
    [
        lambda p: p["model"]["merges"].reverse(),
        lambda p: p["model"]["merges"].__setitem__(slice(0, 2), p["model"]["merges"][1::-1]),
        lambda p: p["pre_tokenizer"].update(add_prefix_space=True),
        lambda p: p["model"].update(ignore_merges=True),
        lambda p: p.update(normalizer={"type": "NFC"}),
    ],
)
def test_other_vocabularies_go_through_the_library(change):
    text = changed(change)
    texts, encoder = odd_texts()[:2000] + ["The words that were merged in the other order"], Encoder(text)
    assert encoder.merging is None
    wanted = [e.ids for e in Tokenizer.from_str(text).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == wanted


def test_very_long_texts(documents, tokenizer):
    rows = [(1, "word é " * 150_000, "en", "a"), (2, " " * 400_000 + "x", "en", "b"), (3, "y" * 300_000, "en", "b")]
    pieces = [r.asDict() for r in pack(documents(rows), byte_tokenizer()).collect()]
    check(pieces, {r[0]: r[1] for r in rows}, tokenizer)
