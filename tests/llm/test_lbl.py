import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyspark
import pytest

from assayer.llm.lbl import Model, _contexts, _model_logs, _scoring, frequent, score_texts, start, triples
from tests.llm.conftest import SF_DIR


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0


def plain(rows):
    counts = Counter()
    for i, t in rows:
        if not held_out(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out.append((i, held_out(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5)))
    return sorted(out, key=repr)


def base(rows):
    return sorted(
        ((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows),
        key=repr,
    )


def test_probabilities_sum_to_one():
    words = [bytes([c]) for c in b"abcdefg"]
    model = start(words, np.array([5.0, 2.0, 7, 6, 5, 4, 3, 2, 1]), width=3)
    rows_, weights = triples([model.number([b"a", b"g", b"e", b"x"])] * 5, model.far())
    model.train(rows_, weights, np.random.default_rng(1))
    logs = model.log_probabilities(np.arange(11), np.arange(11)[::-1])
    # Classes stand for their words, so they are left out of the sum.
    assert (model.first_class, model.top) == (5, 7) and logs.shape[1] == 11
    assert np.allclose(np.exp(np.delete(logs, range(5, 7), axis=1)).sum(axis=1), 1, atol=1e-5)


def test_batched_scores_are_those_of_the_model_one_by_one():
    rng = random.Random(8)
    words = [f"w{i}".encode() for i in range(50)]
    model = start(words, np.array([9.0, 30.0, *range(60, 10, -1)]), width=7)
    texts = [[rng.choice([*words, b"x", b"y", b"z"]) for _ in range(rng.randrange(9))] for _ in range(300)]
    numbered = [model.number(t) for t in texts]
    rows_, weights = triples(numbered, model.far())
    model.train(rows_, weights, np.random.default_rng(1))
    contexts, tokens = _contexts(numbered, model.far())
    got, k = _model_logs(model, contexts, tokens), 0
    for ids in numbered:
        for before, last, token in zip([0, 0, *ids], [0, *ids], ids):
            if before >= model.top:
                before = model.first_class + (before - model.top) // 8
            mixed = [
                sum(float(model.vectors[c][i] * model.mixers[place][i][j]) for place, c in enumerate((before, last)) for i in range(16))
                for j in range(16)
            ]

            def among(output, outputs):
                scores = {o: sum(m * float(t) for m, t in zip([*mixed, 1], model.targets[o])) for o in outputs}
                return scores[output] - math.log(sum(math.exp(s) for s in scores.values()))

            if token < model.top:
                wanted = among(token, range(model.top))
            else:
                at = (token - model.top) // 8  # the root of the vocabulary is more than the width asked for
                mates = range(model.top + 8 * at, min(model.top + 8 * at + 8, len(model.targets)))
                wanted = among(model.first_class + at, range(model.top)) + among(token, mates)
            assert math.isclose(got[k], wanted / math.log(10), rel_tol=1e-3, abs_tol=1e-3)
            k += 1
        if k > 400:
            break


def test_words_are_looked_up_once_for_counts_and_model(monkeypatch):
    words = [f"w{i}".encode() for i in range(30)]
    table = {w: 40 - i for i, w in enumerate(words)}
    model = start(words[:20], np.array([9.0, 60.0, *range(40, 20, -1)]), width=7)
    rng = random.Random(4)
    texts = [[rng.choice([*words, b"x", b"y"]) for _ in range(rng.randrange(7))] for _ in range(50)]
    wanted = []
    for words_ in texts:
        ids, known = model.number(words_), [w for w in words_ if w in table]
        rare = [w for w in known if w not in model.tokens]
        contexts, tokens = _contexts([ids], model.far())
        wanted.append(
            (len(ids), len(known) + 1, sum(math.log10(table[w] + 0.1) for w in known) + math.log10(9.1),
             sum(w not in model.tokens for w in words_), sum(math.log10(table[w] + 0.1) for w in rare),
             _model_logs(model, contexts, tokens).sum(), Counter(w for w in words_ if w not in table))
        )
    calls, number = [], Model.number
    monkeypatch.setattr(Model, "number", lambda self, words_: calls.append(1) or number(self, words_))
    monkeypatch.setattr(pyspark, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 0}))
    columns = [pa.array(range(50), pa.int64()), pa.array([False] * 50), pa.array([b" ".join(t) for t in texts], pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "text"])
    got = pa.Table.from_batches(_scoring(type("Shared", (), {"value": (model, table, 9)}))(iter([batch]))).to_pylist()
    assert len(calls) == 1  # for the table, not for each text
    assert len(got) == len(wanted) and {r["row"] for r in got} == set(range(50))
    for r, (*numbers, others) in zip(got, wanted):
        found = [r[c] for c in ("n_tokens", "n_known", "known_logs", "n_rare", "rare_logs", "model_log")]
        assert np.allclose(found, numbers, rtol=1e-5) and Counter(dict(zip(r["others"], r["times"]))) == others


def test_words_of_equal_count_beyond_the_bound(spark):
    rows = [(f"w{i}".encode(), 1) for i in range(3000)] + [(b"often", 9), (b"", 5)]
    counts = spark.createDataFrame(rows, "word binary, n long").repartition(3)
    for most, wanted in [(0, 0), (1, 1), (500, 500), (3001, 3001), (9000, 3001)]:
        got = frequent(counts, most)
        assert len(got) == wanted and b"" not in got and (not most or got[b"often"] == 9)
        assert got == frequent(counts.repartition(5), most)


def test_long_words_are_told_apart(documents):
    longs = ["x" * 300 + str(i) for i in range(3)]
    rows = [(i, f"a {longs[i % 3]} {longs[0]} B {longs[0]}") for i in range(40)]
    for known in (200_000, 1):
        assert base(score_texts(documents(rows), known=known, vocabulary=1).collect()) == plain(rows)


def test_triples_of_texts():
    found, n = triples([np.array([2, 3, 0]), np.array([2, 0])], np.arange(4))
    assert sorted((*map(int, row), int(k)) for row, k in zip(found, n)) == [(0, 0, 2, 2), (0, 2, 0, 1), (0, 2, 3, 1), (2, 3, 0, 1)]


@pytest.mark.parametrize("known", [200_000, 30])
def test_base_of_all_documents(spark, known):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    got = score_texts(docs, known=known, vocabulary=20).collect()
    assert base(got) == plain(rows)
    assert all(r["score"] < 0 for r in got)


def test_model_beats_the_base_where_order_matters(documents):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(300):
        at, text = rng.randrange(40), []
        for _ in range(60):
            text.append(words[at])
            at = (at + rng.choice([1, 1, 1, 2])) % 40
        rows.append((i, " ".join(text) + f" rare{i}"))
    got = score_texts(documents(rows), vocabulary=64).collect()
    assert base(got) == plain(rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_odd_rows(documents):
    rows = [(1, "A b A"), (2, None), (3, ""), (3, ""), (None, "a  c\x0bd"), (5, "é É a" * 30_000), (20, "unseen words"), (4, "b")]
    got = score_texts(documents(rows), vocabulary=4).collect()
    assert base(got) == plain(rows)
    assert all(math.isfinite(r["score"]) for r in got)


def test_empty_table(documents):
    assert score_texts(documents([])).collect() == []
