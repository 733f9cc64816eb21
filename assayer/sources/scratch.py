"""Intermediate tables in the folder the session names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Tables that are read a few times and then go: fewer bytes written tell more than the time to pack them.
_COMPRESSION = "zstd"

# The wide tables of the layers. Dictionaries take two fifths of the time to write them, and save about a tenth of their bytes.
_WIDE = {"landing", "bronze", "evaluated", "silver"}


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. Without one, a local session uses a folder of its warehouse;
    on a cluster it must be set, and shared."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")


class Scratch:
    """A folder of its own for intermediate tables.

    As a context manager it removes the folder at the end. Used plainly, the tables stay
    while the application runs, since the DataFrames handed out read them lazily, and are
    deleted when it ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._tables: dict[int, tuple[DataFrame, str]] = {}
        self.path = f"{scratch_root(spark)}/assayer-{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a DataFrame that reads it back.

        This cuts the lineage, survives executor loss and gives the optimizer the
        true size of the result.
        """
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.options(compression=_COMPRESSION, **{"parquet.enable.dictionary": name not in _WIDE}).parquet(path)
        self.keep_until_exit()
        table = self._spark.read.schema(df.schema).parquet(path)
        self._tables[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that are not read any more."""
        for table in tables:
            self._delete(self._tables.pop(id(table))[1])

    def keep_until_exit(self) -> None:
        """Have the file system delete the folder, once it exists, when the application ends."""
        folder, files = self._folder(self.path)
        files.deleteOnExit(folder)

    def _folder(self, path: str):
        folder = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        folder, files = self._folder(path)
        files.delete(folder, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc: object) -> None:
        self._delete(self.path)
