"""CSV and Parquet in and out."""

from __future__ import annotations

import csv
import datetime
from collections import Counter
from collections.abc import Callable, Sequence
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from assayer.contracts import date_part_names
from assayer.operators.columns import col
from assayer.sources.folders import Day, Replaced, existing_folders, exists, finish_replacing, folder_name, replace_folders
from assayer.sources.sizing import input_bytes, read_tasks, with_conf, write_tasks

SaveMode = Literal["overwrite", "append", "overwrite_partitions"]

# Shuffled bytes one task of a partitioned write gets; less than half of it ends up in a file. The writer sorts a
# task's rows by folder, where they take some ten times as much: 800 MB, so that they need not be spilled.
_WRITE_TASK_BYTES = 80 * 1024 * 1024

# Packed bytes that a task reads of rows which are written from where they lie: they are sorted, too, and packed tighter.
_READ_TASK_BYTES = 32 * 1024 * 1024

# From this size on, packed, rows of few folders are written from where they lie; bytes that a task then reads at least, and
# files that it may have open. Its rows are not sorted as long as they belong to no more folders.
_SCATTERED_BYTES, _SCATTERED_TASK_BYTES, _OPEN_FILES = 128 * 1024 * 1024, 16 * 1024 * 1024, 16

# Where Spark does not know a size, it takes the largest number.
_MOST_TASKS = (1 << 31) - 1

# Texts of a row that are shuffled as one: what ends each of them, and what comes before a letter that stands for
# something else. Escapes of one letter: the mark itself, the end, null, and bytes that are no UTF-8, as hexadecimal digits.
_END, _MARK = "\t", "\x01"
_MARKED, _ENDED, _NULL, _BYTES = (f"{_MARK}{letter}" for letter in "abnh")

# Files that a folder may get on the average when rows are not brought together first.
_FILES_OF_A_FOLDER = 2

# Differently written headers that are looked at; more of them cannot all be the same names.
_HEADERS_COMPARED = 1000

# Folders that are looked for by name; beyond that the table's folders are listed at once.
_ASKED_ONE_BY_ONE = 16

# Tasks for each core that list folders. Spark would start one for each folder.
_LISTS_OF_A_CORE = 4

# The CSV dialect.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}


def header_options(columns: Sequence[str]) -> dict[str, str]:
    """Have Spark compare the header of each file with these columns, and raise where they differ.

    Where headers are blank or repeated Spark has named the columns itself, and cannot compare.
    """
    stems = Counter(name.removesuffix(str(i)).lower() for i, name in enumerate(columns) if name.endswith(str(i)))
    renamed = any(name == f"_c{i}" for i, name in enumerate(columns)) or any(n > 1 for n in stems.values())
    return {} if renamed else {"enforceSchema": "false"}


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Headered CSV file or folder, all columns as text; quotes are doubled inside quotes.

    With ``multi_line`` a record may hold line breaks inside quotes, and a file is read by one
    task: work spreads over files. Where no record holds a line break, ``multi_line=False``
    splits large files. It then reads a line break inside quotes as the end of a record, and
    a lone carriage return is one too.

    All files must have the header of the first one, in the same order; reading another one
    raises. Spark compares them while it reads. Where headers are blank or repeated it cannot, and
    the first lines of all files are compared before.
    """
    reader = spark.read.options(**CSV_DIALECT, multiLine=multi_line)
    schema = reader.csv(path).schema
    comparable = header_options(schema.names)
    if not comparable:
        compare_headers(spark, path)
    return reader.options(**comparable).schema(schema).csv(path)


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line``: the first line of each file that has one. Every task keeps one line of a file."""
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start")]
    lines = spark.read.text(path).select("value", *place).where("file_block_start = 0")
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    return lines.groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", "at").alias("line"))


def compare_headers(spark: SparkSession, path: str) -> None:
    """ValueError when files have different headers; how a name is quoted makes no difference."""
    texts = first_lines(spark, path).groupBy("line").agg(F.min("file").alias("file")).orderBy("file")
    found: dict[tuple[str, ...], str] = {}
    for row in texts.limit(_HEADERS_COMPARED).collect():
        names = next(csv.reader([row["line"].removeprefix("\ufeff")], doublequote=True), [])
        found.setdefault(tuple(names), row["file"])
    if len(found) > 1:
        raise ValueError(f"Files have different headers, for example {' and '.join(list(found.values())[:2])}")


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """``merge_schema`` shows columns that only later files have, at the price of reading all footers."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema else reader).parquet(path)


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return False
        raise
    return True


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: SaveMode = "overwrite",
    task_bytes: int = _WRITE_TASK_BYTES,
    maybe_sorted: bool = False,
) -> None:
    """Write, optionally in ``name=value`` folders.

    Rows are first brought together by folder, so a folder gets few files instead of
    one from every task. It is a rebalance, not a plain repartition: a folder with very
    many rows is spread over several tasks, and small ones share a task.

    ``maybe_sorted`` is for a ``df`` that reads files which may have been made folder by folder: if so, its rows
    are written from where they lie.

    ``overwrite_partitions`` replaces the folders that occur in ``df`` and no others, as ``replace_days`` does.
    """
    if not partition_by:
        df.write.mode("overwrite" if mode == "overwrite_partitions" else mode).parquet(path)
        return
    if mode == "overwrite_partitions":
        replace_days(df, path, partition_by, (), task_bytes, maybe_sorted)
        return
    _write_folders(df, path, partition_by, mode, task_bytes, maybe_sorted)
    if mode != "overwrite" or not existing_folders(df.sparkSession, path, partition_by[:1]):
        _with_a_file(df, path)


def lies_by_folder(df: DataFrame, partition_by: Sequence[str]) -> bool:
    """Whether the rows of a folder lie in one or two of the files that ``df`` reads, on the average. Looks at the
    folder columns only; false for what is not read from files."""
    try:
        placed = df.select(F.col("_metadata.file_path").alias("_file"), *[col(c) for c in partition_by])
    except AnalysisException:
        return False
    files = placed.distinct().groupBy(*[col(c) for c in partition_by]).agg(F.count(F.lit(1)).alias("n"))
    found = files.agg(F.count(F.lit(1)).alias("folders"), F.sum("n").alias("files")).first()
    return (found["files"] or 0) <= _FILES_OF_A_FOLDER * found["folders"]


def _to_packed(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(_MARK), F.lit(_MARKED)), F.lit(_END), F.lit(_ENDED))
    other = F.when(text.isNull(), _NULL).when(~F.is_valid_utf8(text), F.concat(F.lit(_BYTES), F.hex(text)))
    return other.otherwise(plain)


def _from_packed(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit(_ENDED), F.lit(_END)), F.lit(_MARKED), F.lit(_MARK))
    other = F.when(text == _NULL, F.lit(None).cast("string"))
    return other.when(text.startswith(_BYTES), F.unhex(F.replace(text, F.lit(_BYTES))).cast("string")).otherwise(plain)


def brought_together(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows rebalanced by some columns.

    Their other texts are shuffled as one, since every column of a shuffled row takes a length, a place and
    padding, which pack badly: together these were more than a third of what the lines of Bronze move.
    """
    taken = {name.lower() for name in by}
    texts = [f.name for f in df.schema.fields if f.dataType == StringType() and f.name.lower() not in taken]
    if len(texts) < 2:
        return df.hint("rebalance", *by)
    packed = next(name for n in range(len(df.columns) + 1) if (name := f"_texts{n}") not in {c.lower() for c in df.columns})
    one = F.concat_ws(_END, *[_to_packed(col(name)) for name in texts]).alias(packed)
    moved = df.select(*[col(name) for name in df.columns if name not in texts], one).hint("rebalance", *by)
    parts = moved.withColumn(packed, F.split(packed, _END, -1))
    return parts.select(
        *[
            _from_packed(F.get(packed, F.lit(texts.index(f.name)))).alias(f.name, metadata=f.metadata) if f.name in texts else col(f.name)
            for f in df.schema.fields
        ]
    )


def _write_folders(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str, task_bytes: int, maybe_sorted: bool
) -> None:
    lies = maybe_sorted and lies_by_folder(df, partition_by)
    writer = (df if lies else brought_together(df, partition_by)).write.partitionBy(*partition_by)
    tasks = read_tasks(df.sparkSession, _READ_TASK_BYTES) if lies else write_tasks(df.sparkSession, task_bytes)
    with tasks:
        writer.mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def write_few_folders(df: DataFrame, path: str, partition_by: Sequence[str], scattered_bytes: int = _SCATTERED_BYTES) -> None:
    """``write_parquet`` for a ``df`` that reads files and belongs to a few folders, such as years.

    Many rows stay where they are: each task writes a file for each folder, and those are large enough. Few rows
    are brought together.
    """
    _write_few_folders(df, path, partition_by, "overwrite", scattered_bytes)
    _with_a_file(df, path)


def replace_few_folders(
    df: DataFrame, path: str, partition_by: Sequence[str], days: Sequence[Day] = (), scattered_bytes: int = _SCATTERED_BYTES
) -> Replaced:
    """``replace_days`` for a ``df`` as that of ``write_few_folders``."""
    return _replace(df, path, partition_by, days, lambda beside: _write_few_folders(df, beside, partition_by, "errorifexists", scattered_bytes))


def _write_few_folders(df: DataFrame, path: str, partition_by: Sequence[str], mode: str, scattered_bytes: int) -> None:
    size = input_bytes(df)
    if size < scattered_bytes:
        _write_folders(df, path, partition_by, mode, _WRITE_TASK_BYTES, False)
        return
    spread = df.coalesce(min(max(1, size // _SCATTERED_TASK_BYTES), _MOST_TASKS))
    with with_conf(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(_OPEN_FILES)}):
        spread.write.partitionBy(*partition_by).mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def _with_a_file(df: DataFrame, path: str) -> None:
    """Without rows there are no folders and no file to take a schema from."""
    if not _readable(df.sparkSession, path):
        empty = df.sparkSession.createDataFrame([], df.schema)
        empty.write.mode("append").parquet(path)


def replace_days(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    days: Sequence[Day] = (),
    task_bytes: int = _WRITE_TASK_BYTES,
    maybe_sorted: bool = False,
) -> Replaced:
    """Write the folders that occur in ``df`` anew; those of ``days`` that do not occur in it go.

    ``df`` may read the table: new folders are written beside the old ones before they take their place, and
    a run that breaks off in between leaves a note by which the next one goes on.
    """
    return _replace(
        df, path, partition_by, days, lambda beside: _write_folders(df, beside, partition_by, "errorifexists", task_bytes, maybe_sorted)
    )


def _replace(
    df: DataFrame, path: str, partition_by: Sequence[str], days: Sequence[Day], write: Callable[[str], None]
) -> Replaced:
    emptied = [folder_name(partition_by, day) for day in days]
    done = replace_folders(df.sparkSession, path, partition_by, write, emptied)
    if not done.put:
        _with_a_file(df, path)
    return done


def write_csv(
    df: DataFrame,
    path: str,
    mode: Literal["overwrite", "append"] = "overwrite",
    compression: Literal["none", "gzip"] = "none",
) -> None:
    """Headered CSV copy, a folder with a file from each task. ``read_csv`` tells by a file's name how it is
    compressed; a file in gzip is read by one task."""
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": compression}
    df.write.mode(mode).options(**CSV_DIALECT, **options).csv(path)


def distinct_days(df: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The folders that rows lie in or belong to; as many as there are days."""
    return sorted(tuple(r) for r in df.select(*[col(c) for c in partition_by]).distinct().collect())


def read_days(
    spark: SparkSession, path: str, partition_by: Sequence[str], days: Sequence[Sequence[object]]
) -> DataFrame | None:
    """The rows in the folders of some days, with all their columns, reading nothing else; None without folders."""
    wanted = [folder_name(partition_by, day) for day in days]
    if len(wanted) > _ASKED_ONE_BY_ONE:
        found = existing_folders(spark, path, partition_by)
        there = _by_parent(set(found).intersection(wanted), found)
    else:
        there = {folder for folder in wanted if exists(spark, f"{path.rstrip('/')}/{folder}")}
    if not there:
        return None
    paths = [f"{path.rstrip('/')}/{folder}" for folder in sorted(there)]
    lists = str(_LISTS_OF_A_CORE * spark.sparkContext.defaultParallelism)
    with with_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": lists}):
        return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*paths)


def _by_parent(wanted: set[str], found: Sequence[str]) -> set[str]:
    """The same folders with fewer names: a month or a year for its days, where all that were ``found`` in it are wanted."""
    parents: dict[str, set[str]] = {}
    for folder in found:
        parents.setdefault(folder.rpartition("/")[0], set()).add(folder)
    if not wanted or "" in parents:
        return wanted
    whole = {parent for parent, folders in parents.items() if folders <= wanted}
    single = {folder for folder in wanted if folder.rpartition("/")[0] not in whole}
    return single | _by_parent(whole, sorted(parents))


def add_to_days(
    new: DataFrame, path: str, partition_by: Sequence[str], keep: Callable[[DataFrame], DataFrame]
) -> Replaced:
    """Add rows to a table in day folders, so that adding them again changes nothing.

    The folders of the new rows are written anew, from those old rows that ``keep`` leaves,
    which should drop the rows of an earlier attempt, and the new ones. Other folders are not
    touched. ``new`` must be a written table.
    """
    finish_replacing(new.sparkSession, path)
    old = read_days(new.sparkSession, path, partition_by, distinct_days(new, partition_by))
    if old is not None:
        new = keep(old).unionByName(new, allowMissingColumns=True)
    return replace_days(new, path, partition_by)


def between_days(
    df: DataFrame, first: datetime.date, last: datetime.date, prefix: str = "order"
) -> DataFrame:
    """Rows of a table laid out by year, month and day folders, reading only those folders.

    A condition on the date column itself would read all of them.
    """
    day = F.make_date(*[col(name) for name in date_part_names(prefix)])
    return df.where(day.between(F.lit(first), F.lit(last)))
