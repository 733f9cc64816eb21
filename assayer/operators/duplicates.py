"""Keep one row per key, chosen by content, however many copies a key has.

A window over the key would pull all copies of a key into one task and sort the whole
table. Here wide rows move once at most, and no more than ``PER_KEY`` copies of a key meet:

1. repeated keys   one narrow aggregation over the key column alone
2. contenders      key, fingerprint, tie-breakers and place of the rows of those keys; most rows of other
                   keys go before, by a bit for each hash
3. losers          the places of all contenders but the best of each key. They are shuffled once, by key, and
                   ranked there; the few rows of other keys that are left come first of their key. Where
                   one key has more than ``PER_KEY`` rows, contenders are first joined with the repeated keys,
                   the rows of such keys dealt to several tasks, and the best is found with one candidate
                   for each task and key
4. the mark        all rows against the losers on the place, which is unique; the losers are one
                   bit for each row of a block of rows, so that no wide row is shuffled for it

A place is a file and a row number in it, so it costs nothing to give out, and a lost
executor cannot change it. The results of 1-4 are written tables without the rows'
contents, so Spark sees their true sizes: it broadcasts the small ones by its own
threshold and shuffles the others. Of the bits a fixed number of blocks is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions import fingerprint
from assayer.operators.columns import SOURCE_FILE, col
from assayer.sources.scratch import Scratch

PLACE = ["_in_file", "_at_row"]
#: Rows of one key that may meet in a task.
PER_KEY = 1 << 20
#: Rows of a block, which is what Spark's bitmaps hold, and blocks that are broadcast: 64 MB, half a billion rows.
BLOCK_ROWS, BLOCKS = 1 << 15, 1 << 14
_PRINT, _RANK, _COUNT, _COPIES, _SALT, _BLOCK, _BITS = "_print", "_rank", "_n", "_copies", "_salt", "_block", "_bits"


def payload_columns(df: DataFrame) -> list[str]:
    """Business columns. Lineage (leading underscore) would change the choice per run."""
    return [name for name in df.columns if not name.startswith("_")]


def tie_columns(df: DataFrame) -> list[str]:
    """What settles equal fingerprints, the same in every run: the original texts, then the source file."""
    return [c for c in df.columns if c.startswith("_raw_")] + [c for c in df.columns if c == SOURCE_FILE]


def with_fingerprint(df: DataFrame, payload: Sequence[str] | None = None, name: str = _PRINT) -> DataFrame:
    return df.withColumn(name, fingerprint(col(c) for c in payload or payload_columns(df)))


def with_place(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Add each row's file, as a hash, and row number. What is not read from Parquet files is written first."""

    def placed(rows: DataFrame) -> DataFrame:
        file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
        return rows.select("*", file.alias(PLACE[0]), row.alias(PLACE[1]))

    try:
        return placed(df)
    except AnalysisException:
        return placed(scratch.stage(df, "rows"))


def repeated_counts(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, and on how many; null is not a key."""
    counts = df.where(col(key).isNotNull()).groupBy(col(key)).agg(F.count(F.lit(1)).alias(_COUNT))
    return counts.where(col(_COUNT) > 1)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return repeated_counts(df, key).select(col(key))


def rows_of(df: DataFrame, repeated: DataFrame, key: str, per_key: int = PER_KEY) -> DataFrame:
    """The rows of ``df`` whose key is in ``repeated``, a written table of ``repeated_counts``.

    A key with more than ``per_key`` rows is listed several times, and its rows are dealt to these copies by
    their place, so that they do not meet in one task when the join is shuffled. There are no more such
    keys than ``per_key`` goes into the rows, so the list of them alone is broadcast.
    """
    copies = (col(_COUNT) - 1 - (col(_COUNT) - 1) % per_key) / per_key + 1
    hot = repeated.select(col(key), copies.cast("long").alias(_COPIES)).where(col(_COPIES) > 1)
    if hot.isEmpty():
        return df.join(repeated, key, "left_semi")
    salt = F.pmod(F.xxhash64(*PLACE), F.coalesce(col(_COPIES), F.lit(1)))
    dealt = df.join(F.broadcast(hot), key, "left").withColumn(_SALT, salt)
    last = copies.cast("long") - 1
    listed = repeated.select(col(key), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias(_SALT))
    return dealt.join(listed, [key, _SALT], "left_semi").select(*[col(c) for c in df.columns])


def _block(number: Column) -> Column:
    return F.shiftright(number, BLOCK_ROWS.bit_length() - 1)


def _bitmaps(df: DataFrame, number: Column, *by: Column) -> DataFrame:
    """The bits of all numbers, a row for each block, as an array of words: that is read where it lies, while of a
    binary every row that looks at it gets a copy."""
    bits = F.bitmap_construct_agg(F.pmod(number, F.lit(BLOCK_ROWS))).alias(_BITS)
    blocks = df.groupBy(*by, _block(number).alias(_BLOCK)).agg(bits)

    def word(i: Column) -> Column:
        unsigned = F.conv(F.hex(F.substring(col(_BITS), i * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
        return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned).cast("int")

    return blocks.withColumn(_BITS, F.transform(F.sequence(F.lit(0), F.lit(BLOCK_ROWS // 32 - 1)), word))


def _has(number: Column) -> Column:
    """Whether a number's bit is set in its block's bitmap; false without a bitmap."""
    place = F.pmod(number, F.lit(BLOCK_ROWS)).cast("int")
    word = F.get(col(_BITS), F.shiftright(place, 5))
    # The first byte of a word is its highest.
    return F.coalesce(F.getbit(word, place.bitwiseAND(31).bitwiseXOR(24)) == 1, F.lit(False))


def _may_broadcast(df: DataFrame) -> bool:
    """A session that has turned broadcasts off gets none."""
    return df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def probably_in(df: DataFrame, repeated: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``df`` without most rows whose key is not in ``repeated``, a written table; no row whose key is in it goes.

    Each key sets the bit of its hash, of eight bits a key as long as ``BLOCKS`` hold them. The bits are
    broadcast, so the rows stay where they are.
    """
    blocks = min(BLOCKS, -(-repeated.count() * 8 // BLOCK_ROWS))
    spot = F.pmod(F.xxhash64(col(key)), F.lit(blocks * BLOCK_ROWS))
    bits = scratch.stage(_bitmaps(repeated, spot), "key-bits")
    return df.join(F.broadcast(bits), (_block(spot) == col(_BLOCK)) & _has(spot), "left_semi")


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key. Filtering on rank 1 lets Spark cut each task to one row per key."""
    ranking = Window.partitionBy(col(key)).orderBy(*[col(c) for c in order])
    return df.withColumn(_RANK, F.row_number().over(ranking)).where(col(_RANK) == 1).drop(_RANK)


def later_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """All rows but the first of each key. The rows of a key meet in one task."""
    ranking = Window.partitionBy(col(key)).orderBy(*[col(c) for c in order])
    return df.withColumn(_RANK, F.row_number().over(ranking)).where(col(_RANK) > 1).drop(_RANK)


def losing_places(
    df: DataFrame,
    key: str,
    payload: Sequence[str] | None = None,
    scratch: Scratch | None = None,
    per_key: int = PER_KEY,
) -> DataFrame | None:
    """The places of all copies but the kept one of each key; None when no key repeats.

    ``df`` has the columns of ``with_place``. The kept copy has the smallest fingerprint; ties
    go by the columns of ``tie_columns``. Rows that are equal in all of these are interchangeable.
    Rows with a null key are never copies, and take no part in any join.
    """
    scratch = scratch or Scratch(df.sparkSession)
    repeated = scratch.stage(repeated_counts(df, key), "repeated-keys")
    if repeated.isEmpty():
        return None
    order = [_PRINT, *tie_columns(df), *PLACE]
    # Reduced to what the ranking needs before the join, so that no wide row is shuffled for it.
    likely = df.where(col(key).isNotNull())
    if _may_broadcast(df):
        likely = probably_in(likely, repeated, key, scratch)
    narrow = with_fingerprint(likely, payload).select(*[col(c) for c in [key, *order]])
    # The bytes of a fingerprint have the order of its digits, in half the space.
    narrow = narrow.withColumn(_PRINT, F.unhex(_PRINT))
    if _may_broadcast(df) and repeated.where(col(_COUNT) > per_key).isEmpty():
        return scratch.stage(later_per_key(narrow, key, *order).select(*PLACE), "losers")
    contenders = scratch.stage(rows_of(narrow, repeated, key, per_key), "contenders")
    kept = scratch.stage(first_per_key(contenders, key, *order).select(*PLACE), "kept")
    return scratch.stage(contenders.select(*PLACE).join(kept, PLACE, "left_anti"), "losers")


def mark_duplicates(
    df: DataFrame,
    key: str,
    payload: Sequence[str] | None = None,
    flag: str = "_is_duplicate",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Add ``flag``: false for the kept row of each key and for null keys, else true.

    ``df`` may have the columns of ``with_place``, which are then dropped; else it is given
    places here. It is read several times and must give the same rows each time (a file scan does).
    """
    scratch = scratch or Scratch(df.sparkSession)
    columns = [col(c) for c in df.columns if c not in PLACE]
    placed = df if set(PLACE) <= set(df.columns) else with_place(df, scratch)
    losers = losing_places(placed, key, payload or payload_columns(df), scratch)
    if losers is None:
        return placed.select(*columns, F.lit(False).alias(flag))
    row = col(PLACE[1])
    lost = scratch.stage(_bitmaps(losers, row, col(PLACE[0])), "lost")
    if _may_broadcast(df) and lost.count() <= BLOCKS:
        lost = F.broadcast(lost)
    marked = placed.withColumn(_BLOCK, _block(row)).join(lost, [PLACE[0], _BLOCK], "left")
    return marked.select(*columns, _has(row).alias(flag))
