"""The registered queries of this package: each operator, with production parameters, on its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.decontamination import find_contamination
from assayer.llm.langid import identify_languages
from assayer.llm.lbl import score_texts
from assayer.llm.merkle import tampered_proofs
from assayer.llm.packing import pack
from assayer.llm.periodic import describe_runs, find_runs
from assayer.llm.repeats import find_repeats
from assayer.llm.sharding import shard_groups
from assayer.llm.simhash import near_duplicates
from assayer.llm.tokencount import count_tokens
from assayer.llm.topk import top_k
from assayer.llm.toxicity import score_toxicity
from assayer.llm.warc import archive


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_tokenizer() -> str:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def piece_model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents")).drop("letterless")


def op2_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_repeats(table(spark, sf_dir, "documents"), length=200)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op5_archive_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, seed=42)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), byte_tokenizer(), size=1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), piece_model(), limit=4096)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_groups(table(spark, sf_dir, "documents"), shards=16)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    return tampered_proofs(docs, columns, "lang", "doc_id", {"text": lower}, third)


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In a tenth of the texts, by their id, the words from one on repeat the first few of them. Rows without id stay."""
    if doc_id is None or not words:
        return words
    drawn, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    first = drawn % len(words)
    left = len(words) - first
    part = words[first : first + 1 + left // (3 + drawn % 8)]
    return words[:first] + (part * (left // len(part) + 1))[:left]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_runs(find_runs(table(spark, sf_dir, "documents"), exponent=4, length=6, rewrite=plant_period))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_top_k_search,
        op3_repeated_strings,
        op4_language_model,
        op5_archive_index,
        op6_decontamination,
        op7_near_duplicates,
        op8_packing,
        op9_token_counts,
        op10_toxicity,
        op11_best_fit_shards,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
}

# --- the same as SQL, where SQL can express it -------------------------------------------

_TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 10
"""

_ARCHIVE = """
WITH described AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages
),
largest AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM described
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN newest END AS refers_to
FROM largest
"""


def _words(column: str) -> str:
    lower = f"translate({column}, '{_UPPER}', '{_UPPER.lower()}')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


_DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT item_id, {_words("coalesce(text, '')")} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS passage
    FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
          FROM items WHERE len(w) > 0)
),
places AS (
    SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS passage
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
),
hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, passage)),
found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
    FROM hits GROUP BY doc_id
),
covered AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN found USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

def _encoded(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bit = "xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda crc, byte: {byte}), 4294967295)"


_ROW = " || ".join(map(_encoded, ("doc_id", "source", "lang", "n_chars")))
_MERKLE = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, sha256({_ROW} || {_encoded("text")}) AS leaf,
           CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
                THEN sha256({_ROW} || {_encoded(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")}) END AS changed
    FROM documents
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS n
    FROM docs
),
nodes(lang, level, idx, n, digest) AS (
    SELECT lang, 0, idx, n, leaf FROM leaves
    UNION ALL
    SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8, (n + 7) // 8
),
subroots AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
tops(level, idx, n, digest) AS (
    SELECT 0, idx, n, digest FROM subroots
    UNION ALL
    SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE n > 1 GROUP BY level, idx // 8, (n + 7) // 8
),
runs AS (
    SELECT lang, level, idx // 8 AS run, list(digest ORDER BY idx) AS digests
    FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 8
),
top_runs AS (
    SELECT level, idx // 8 AS run, list(digest ORDER BY idx) AS digests FROM tops WHERE n > 1 GROUP BY level, idx // 8
),
places AS (
    SELECT l.lang, l.idx, r.level, r.digests, (l.idx // (1::BIGINT << (3 * r.level))) % 8 AS pos
    FROM leaves l JOIN runs r ON l.lang IS NOT DISTINCT FROM r.lang AND l.idx // (1::BIGINT << (3 * r.level + 3)) = r.run
    UNION ALL
    SELECT l.lang, l.idx, 100 + r.level, r.digests, (s.idx // (1::BIGINT << (3 * r.level))) % 8
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
    JOIN top_runs r ON s.idx // (1::BIGINT << (3 * r.level + 3)) = r.run
),
steps AS (
    SELECT lang, idx, level, array_to_string(digests[1:pos], '') AS l, array_to_string(digests[pos + 2:], '') AS r
    FROM places
),
paths AS (
    SELECT lang, idx, string_agg(l || r, '' ORDER BY level) AS siblings, list({{'l': l, 'r': r}} ORDER BY level) AS path
    FROM steps GROUP BY lang, idx
),
proofs AS (
    SELECT v.doc_id, v.leaf, s.digest AS subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
           sha256(coalesce(p.siblings, '')) AS proof_sha256,
           list_reduce(list_concat([{{'l': '', 'r': coalesce(v.changed, v.leaf)}}], coalesce(p.path, [])),
                       lambda a, b: {{'l': '', 'r': sha256(b.l || a.r || b.r)}}).r AS folded_root
    FROM leaves v JOIN subroots s ON v.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN paths p ON v.lang IS NOT DISTINCT FROM p.lang AND v.idx = p.idx
)
SELECT *, folded_root = root AS verified FROM proofs
"""

ORACLE: dict[str, str] = {
    "op2_top_k_search": _TOP_K,
    "op5_archive_index": _ARCHIVE,
    "op6_decontamination": _DECONTAMINATION,
    "op12_merkle_manifest": _MERKLE,
}
