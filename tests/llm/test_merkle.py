import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from assayer.llm.merkle import folded, manifest, tampered_proofs
from assayer.llm.queries import ORACLE, op12_merkle_manifest
from tests.llm.conftest import SF_DIR, found

NAMES = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in COLUMNS)]
    return sha("".join(parts))


def plain_tree(leaves, fan):
    """The root, and the siblings of each leaf as (left, right) of each level."""
    paths, level, owners = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [level[i : i + fan] for i in range(0, len(level), fan)]
        for at, below in enumerate(owners):
            run, pos = runs[at // fan], at % fan
            for i in below:
                paths[i].append(("".join(run[:pos]), "".join(run[pos + 1 :])))
        owners = [sum(owners[i : i + fan], []) for i in range(0, len(owners), fan)]
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def plain(rows, fan=8):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    subroots, per_group = [], []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        order = sorted(groups[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        subroot, paths = plain_tree([plain_leaf(r) for r in order], fan)
        subroots.append(subroot)
        per_group.append((order, paths))
    if not subroots:
        return []
    root, tops = plain_tree(subroots, fan)
    out = []
    for (order, paths), subroot, top in zip(per_group, subroots, tops):
        for row, path in zip(order, paths):
            changed = dict(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"]:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
            below = plain_leaf(changed)
            for left, right in path + top:
                below = sha(left + below + right)
            siblings = sha("".join(a + b for a, b in path + top))
            out.append((row["doc_id"], plain_leaf(row), subroot, root, siblings, below, below == root))
    return sorted(out, key=repr)


def checked(docs, fan=8, per_key=4096):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return tampered_proofs(docs, COLUMNS, "lang", "doc_id", {"text": lower}, third, fan, per_key)


def as_rows(docs):
    return [{c: r[docs.columns.index(c)] for c in COLUMNS} for r in docs.collect()]


def test_query_by_brute_force_and_sql(spark, duck):
    got = found(op12_merkle_manifest(spark, SF_DIR), *NAMES)
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}
    result = duck.execute(f"SELECT {', '.join(NAMES)} FROM ({ORACLE['op12_merkle_manifest']})").fetchall()
    assert got == sorted(result, key=repr)


@pytest.mark.parametrize(("fan", "per_key"), [(8, 4096), (2, 2), (3, 1)])
def test_odd_rows(documents, fan, per_key):
    random.seed(fan)
    rows = [(i, f"Text {i} " * random.randrange(4), random.choice(["en", "de", "en"])) for i in range(70)]
    rows += [(5, "Text 5", "en"), (5, "Text 5", "en"), (None, "A", "en"), (None, None, None), (3, "B", None)]
    rows += [(900, "Lone", "é"), (901, "", "Z"), (902, "A b" * 9000, "z"), (903, "É Ä", "z")]
    docs = documents(rows)
    assert found(checked(docs, fan, per_key), *NAMES) == plain(as_rows(docs), fan)


@pytest.mark.parametrize("count", [0, 1, 2, 8, 9, 64, 65])
def test_one_group(documents, count):
    docs = documents([(i * 7, f"T{i}", "en") for i in range(count)])
    assert found(checked(docs), *NAMES) == plain(as_rows(docs))


def test_many_groups(documents):
    docs = documents([(i, f"T{i}", f"l{i % 75}") for i in range(100)])
    assert found(checked(docs), *NAMES) == plain(as_rows(docs))


def test_manifest_names_groups_and_keeps_columns(spark):
    rows = [(i % 3, i, sha(str(i)), i * 2) for i in range(20)]
    made = manifest(spark.createDataFrame(rows, "g int, at int, leaf string, kept int"), "g", "at", fan=4)
    assert found(made.groups, "g", "n") == [(0, 7), (1, 7), (2, 6)]
    proofs = made.proofs.select("g", "at", "kept", "leaf", folded(F.col("leaf"), F.col("path")).alias("root")).collect()
    assert sorted(r[:4] for r in proofs) == sorted((g, at, kept, leaf) for g, at, leaf, kept in rows)
    assert {r["root"] for r in proofs} == {made.root}


def test_a_run_needs_two(spark):
    with pytest.raises(ValueError):
        manifest(spark.createDataFrame([], "g int, at int, leaf string"), "g", "at", fan=1)
