from collections import Counter

import corpus_pipeline
from assayer.llm.frames import pick
from assayer.llm.queries import byte_tokenizer
from tests.llm.conftest import SF_DIR


def text(seed, n=120):
    return " ".join(f"word{seed}x{i * (seed + 3)}" for i in range(n))


def without_repeats(texts, length=200):
    """Brute force: each text without the bytes that a string of this length covers which also starts elsewhere."""
    texts = {i: t.encode() for i, t in texts.items()}
    seen = Counter(t[k : k + length] for t in texts.values() for k in range(len(t) - length + 1))
    kept = {}
    for i, t in texts.items():
        repeated = {j for k in range(len(t) - length + 1) if seen[t[k : k + length]] > 1 for j in range(k, k + length)}
        kept[i] = bytes(b for j, b in enumerate(t) if j not in repeated).decode()
    return kept


def test_stages_in_turn(spark, documents, tmp_path):
    passage = "a shared passage of text that is quite long " * 8
    rows = [(i, text(i), "en", f"s{i % 2}") for i in range(20)]
    rows += [
        (30, None, "en", "s0"),
        (31, "123 !!", "en", "s0"),
        (32, text(3), "en", "s1"),  # a copy
        (33, text(50) + passage + text(51), "en", "s0"),
        (34, text(52) + passage + text(53), "en", None),
        (35, text(54) + " the item of the test set with ten words exactly here", "en", "s1"),
        (36, "short and clean", "en", "s1"),
    ]
    folder = str(tmp_path)
    pick(documents(rows), *corpus_pipeline.COLUMNS, "score", "_spans").write.parquet(f"{folder}/documents.parquet")
    items = [(1, "The item of the test set, with ten words exactly here."), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        kept[name] = docs
        if k < 4:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    ids = {n: {r["doc_id"] for r in d.collect()} for n, d in kept.items()}
    clean = {*range(20), 36}
    assert ids["language id"] == clean | {32, 33, 34, 35}
    assert ids["simhash near-dedup"] == clean | {33, 34, 35}
    cut = {r["doc_id"]: r for r in kept["suffix-array dedup"].collect()}
    assert set(cut) == clean | {33, 34, 35}
    plain = without_repeats({r["doc_id"]: r["text"] for r in kept["simhash near-dedup"].collect()})
    assert {i: r["text"] for i, r in cut.items()} == plain
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    assert passage not in cut[33]["text"] and len(cut[33]["text"]) < len(text(50) + text(51)) + 5
    assert all(cut[i]["text"] == text(i) for i in range(20))
    assert ids["benchmark decontamination"] == clean | {33, 34} == ids["packing"]
    assert kept["packing"].count() == corpus_pipeline.run(spark, folder).count()


def test_rows_are_judged_by_themselves_whatever_their_id(spark, documents, tmp_path):
    """Null and repeated ids: clean, unequal rows stay, and one of each group of copies."""
    item = " the item of the test set with ten words exactly here"
    rows = [(None, text(i), "en", "s0") for i in range(6)] + [(7, text(10 + i), "en", "s1") for i in range(4)]
    rows += [(None, text(2), "en", "s0"), (None, text(3), "en", "s1"), (7, text(11), "en", "s1"), (9, text(4), "en", "s0")]
    rows += [(None, None, "en", "s0"), (7, "12 !", "en", "s0"), (None, text(20) + item, "en", "s0"), (7, text(21) + item, "en", "s0")]
    folder = str(tmp_path)
    pick(documents(rows), *corpus_pipeline.COLUMNS).write.parquet(f"{folder}/documents.parquet")
    items = [(1, "The item of the test set, with ten words exactly here.")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        kept[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    clean = [(None, text(i)) for i in (0, 1, 2, 3, 5)] + [(9, text(4))] + [(7, text(10 + i)) for i in range(4)]
    dirty = [(None, text(20) + item), (7, text(21) + item)]
    assert kept["language id"] == sorted([(r[0], r[1]) for r in rows[:14]] + dirty, key=repr)
    assert kept["simhash near-dedup"] == sorted(clean + dirty, key=repr)
    assert kept["benchmark decontamination"] == sorted(clean, key=repr)


def test_documents_without_any_language_stay(spark, documents, tmp_path):
    docs = documents([(i, text(i)) for i in range(5)] + [(6, None), (7, "12 !")])
    kept = corpus_pipeline.known_language(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(5))


def test_given_documents(spark):
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    lengths = {}
    for p in pieces:
        lengths[p["sequence_id"]] = lengths.get(p["sequence_id"], 0) + p["length"]
    assert sum(n != 1024 for n in lengths.values()) <= 10 and len(byte_tokenizer()) > 0


def test_empty_table(spark, documents, tmp_path):
    pick(documents([]), *corpus_pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_documents_between_languages_go(spark, documents, tmp_path):
    """The prediction decides, not the given language."""
    english, french = "the cat and the dog sat there", "le chat et le chien sont là"
    rows = [(i, english if i % 2 else french, "en" if i % 2 else "fr") for i in range(40)]
    rows += [(50, f"{english} {french}", None), (51, english, None)]
    kept = corpus_pipeline.known_language(spark, documents(rows), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 51]
