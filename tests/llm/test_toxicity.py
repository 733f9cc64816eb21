import numpy as np
import pytest

from assayer.llm.queries import QUERIES
from assayer.llm.toxicity import BUCKETS, add_pairs, candidates, fit, score_toxicity, terms


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")


def test_pairs_of_terms_are_learned():
    """Neither word alone says anything; both together do."""
    rng = np.random.default_rng(2)
    documents, wanted = [], []
    for _ in range(1500):
        insult, group = rng.random(2) < 0.5
        held = [1] * int(insult) + [2] * int(group) + rng.integers(10, 30, 3).tolist()
        documents.append(np.array(sorted(set(held)), np.int32))
        wanted.append(float(insult and group))
    machine = fit(documents, np.array(wanted), [1, 2, *range(10, 30)], epochs=40)
    place = machine.place
    scores = [machine.score([place[t] for t in held if t in place]) for held in ([], [1], [2], [1, 2])]
    assert max(scores[:3]) < 0.5 < scores[3]


def test_pair_sum_equals_the_sum_over_pairs():
    documents = [np.array([1, 2, 3], np.int32), np.array([4], np.int32)] * 20
    machine = fit(documents, np.array([1.0, 0.0] * 20), [1, 2, 3, 4], epochs=3)
    every = list(range(len(machine.place)))
    pairs = sum(float(machine.factors[i] @ machine.factors[j]) for i in every for j in every if i < j)
    logit = machine.bias + machine.weights.sum() + pairs
    assert abs(machine.score(every) - 1 / (1 + np.exp(-logit))) < 1e-9


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").collect()}
    got = QUERIES["op10_toxicity"](spark, sf_dir).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    found = np.array([(r["predicted"], truth[r["doc_id"]]) for r in held])
    assert (found[:, 0] == found[:, 1]).mean() > 0.97
    assert found[found[:, 1] == 1][:, 0].mean() > 0.85 and found[found[:, 1] == 0][:, 0].mean() < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_odd_rows(documents, labels):
    rows = [(i, f"plain words {i} " + ("you moron" if i % 3 == 0 else "")) for i in range(90)]
    marks = [(i, int(i % 3 == 0)) for i in range(90)] + [(5, None), (6, 7), (None, 1), (1000, 1), (3, 1)]
    rows += [(200, None), (201, ""), (202, "moron " * 40_000), (203, "MORON"), (203, "MORON"), (None, "nice")]
    got = score_toxicity(documents(rows), labels(marks)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert [by_id[i]["predicted"] for i in (200, 201, 202, 203, None)] == [0, 0, 1, 1, 0]
    assert by_id[200]["score"] == by_id[201]["score"]


def test_nothing_to_learn_from(documents, labels):
    assert score_toxicity(documents([]), labels([(1, 1)])).collect() == []
    scores = {r["score"] for r in score_toxicity(documents([(1, "a"), (2, None)]), labels([])).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() < 0.5


def test_shares_of_the_classes_hold_when_both_are_sampled(documents, labels):
    """One text in ten is toxic, and three in ten of those with a weak term: they stay below a half."""
    marks = [(i, int(i % 10 == 0 if i < 900 else i % 10 < 3)) for i in range(1200)]
    texts = documents([(i, "plain" if i < 900 else "plain weak") for i in range(1200)] + [(5000, "plain weak"), (5001, None)])
    scores = {}
    for most in (30, 6000):
        got = {r["doc_id"]: r for r in score_toxicity(texts, labels(marks), most=most).collect()}
        scores[most] = [got[i]["score"] for i in (5000, 5001)]
        assert got[5000]["predicted"] == 0
    assert np.allclose(scores[30], scores[6000], atol=0.15)


def test_terms():
    found = terms("Idiots, idiotic".encode())
    assert all(0 <= t < BUCKETS for t in found) and len(found) == 2 + 3


@pytest.mark.parametrize("rule", [lambda a, b: a == b, lambda a, b: a != b])
def test_pairs_whose_terms_say_nothing_alone(documents, labels, rule):
    """Toxic with both words or neither (or with one): no word by itself has a signal."""
    rows, marks = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        rows.append((i, f"filler{i % 7} common{i // 4 % 5} " + "alpha " * a + "gamma " * b))
        marks.append((i, int(rule(a, b))))
    got = score_toxicity(documents(rows), labels(marks)).collect()
    held = [(r["predicted"], marks[r["doc_id"]][1]) for r in got if r["held_out"]]
    assert len(held) > 200 and np.mean([p == m for p, m in held]) > 0.98


def test_no_terms_are_added_by_chance():
    rng = np.random.default_rng(4)
    documents = [np.flatnonzero(rng.random(300) < 0.3) for _ in range(3000)]
    labels = np.array([float(rng.random() < (0.6 if 1 in d else 0.1)) for d in documents])
    assert add_pairs(documents, labels, [1], list(range(300))) == [1]


def test_candidates_equal_counts_by_hand(spark):
    rng = np.random.default_rng(5)
    held = [(sorted(set(rng.integers(0, 40, 8).tolist())), int(rng.random() < 0.3)) for _ in range(400)]
    held = [(t + [100] * m + [101], m) for t, m in held]
    alone, often = candidates(spark.createDataFrame(held, "terms array<int>, toxic int"), 5, 3)
    spread = {t: sum(t in d for d, _ in held) for t in range(40)}
    spread[100] = sum(m for _, m in held)
    assert alone[0] == 100 and 101 not in alone + often
    assert often == sorted(spread, key=lambda t: (-min(spread[t], 400 - spread[t]), t))[:3]
    assert candidates(spark.createDataFrame([([1], 1)], "terms array<int>, toxic int")) == ([], [])


def test_repeated_ids_and_rows(documents, labels):
    """One id with very many texts and copies is a row of the labels like others."""
    rows = [(i, "you moron" if i % 2 else "nice words") for i in range(60)] + [(7, "nice words")] * 500 + [(7, f"other {i}") for i in range(50)]
    got = score_toxicity(documents(rows), labels([(i, i % 2) for i in range(60)]), most=40).collect()
    assert len(got) == len(rows) and {r["predicted"] for r in got if r["doc_id"] in (11, 13)} == {1}
