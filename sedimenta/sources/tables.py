"""Tables on shared storage: reading, replacing, publishing a layer, batches, CSV.

A layer is a folder with one run folder per publication and one small catalogue file per
version that tells which path each table name stands for. Readers follow the newest file, so
a publication becomes visible as a whole, and two at once end up one after the other.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.session import file_system, path_exists, together, write_counted
from sedimenta.sources.landing import column

_PATIENCE = 5.0
_one_publication = threading.Lock()  # file systems differ in how they race inside one process


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, optional: bool = False
) -> DataFrame:
    """Full scan of a Parquet table.

    A missing table is an error unless it is optional; then it is empty and needs the
    schema it would have.
    """
    if optional and schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


class Layer:
    """A set of tables that is published together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _entries(self, below: int | None = None) -> tuple[int, Mapping[str, str]]:
        """The newest version (below a number): its number, and the path of each table name.

        Every version is one file. One that is still being written does not parse yet, so the version before holds.
        """
        files, _ = file_system(self.spark, self.root)
        for number, path in self._versions():
            if below is not None and number >= below:
                continue
            stream = files.open(path)
            try:
                return number, json.loads(bytes(stream.readAllBytes()))
            except ValueError:
                continue
            finally:
                stream.close()
        return 0, {}

    def _versions(self) -> list[tuple[int, object]]:
        """Number and path of every version file, finished or not, the newest first."""
        files, folder = file_system(self.spark, f"{self.root}/_catalogue")
        if not files.exists(folder):
            return []
        paths = [f.getPath() for f in files.listStatus(folder)]
        found = [(int(p.getName().removesuffix(".json")), p) for p in paths if p.getName().endswith(".json")]
        return sorted(found, key=lambda x: x[0], reverse=True)

    def names(self) -> list[str]:
        return sorted(self._entries()[1])

    def read(self, name: str) -> DataFrame:
        tables = self._entries()[1]
        if name not in tables:
            raise KeyError(f"{name} is not in {self.root}")
        return self.spark.read.parquet(tables[name])

    def _publish(self, change: Callable[[Mapping[str, str]], Mapping[str, str]]) -> None:
        """Write the next version, which `change` makes of the newest one.

        The file of a version is never overwritten: a publication that finds it taken starts from that one. One
        that stays unfinished for `_PATIENCE` seconds may have been left behind by a failure, and its number is passed
        over. No change is lost if it was only slow: a publication takes its number first and then reads what it
        starts from, and when its file is finished it looks for higher numbers. If there is one, it was passed over
        and publishes again on top of that. `change` may so be applied twice.

        This asks for a store on which a file, once created, is seen by all, and creating it a second time fails: a
        local disk used by one host, or HDFS. On plain object stores publish from one process at a time.
        """
        waited = 0.0
        while True:
            with _one_publication:
                version = self._entries()[0] + 1
                taken = {number for number, _ in self._versions()}
                while version in taken and waited >= _PATIENCE:
                    version += 1
                files, path = file_system(self.spark, f"{self.root}/_catalogue/{version:012d}.json")
                if version in taken:  # another process is writing it
                    time.sleep(0.1)
                    waited += 0.1
                    continue
                try:
                    stream = files.create(path, False)
                except Py4JJavaError as e:
                    if "FileAlreadyExists" not in str(e):
                        raise
                    continue
                tables = self._entries(below=version)[1]
                stream.write(bytearray(json.dumps(dict(change(tables))).encode()))
                stream.close()
                if self._versions()[0][0] == version:
                    return

    def replace(self, name: str, df: DataFrame) -> bool:
        """Replace one table. An empty frame leaves the old one in place."""
        path = f"{self.root}/{uuid.uuid4().hex}/{name}"
        if not write_counted(df, path):
            return False
        self._publish(lambda tables: {**tables, name: path})
        return True

    def refresh(
        self,
        tables: Mapping[str, DataFrame],
        keep_suffix: str = "_ia",
        skip_empty: bool = False,
        check: Callable[[Mapping[str, DataFrame]], None] | None = None,
    ) -> list[str]:
        """Full refresh: all tables of the layer or none.

        Tables of the old version drop out, except those whose name ends in
        `keep_suffix` (enrichment that the refresh does not compute); these are carried
        over by their path, without a copy. `check` sees the written tables before they are
        published and raises to keep the old version.
        """
        run = uuid.uuid4().hex

        def write(name: str) -> tuple[str, int]:
            path = f"{self.root}/{run}/{name}"
            return path, write_counted(tables[name], path)

        done = together({name: partial(write, name) for name in tables})
        written = {name: path for name, (path, rows) in done.items() if rows or not skip_empty}
        if check is not None:
            check({name: self.spark.read.parquet(path) for name, path in written.items()})
        self._publish(lambda old: {**{n: p for n, p in old.items() if n.endswith(keep_suffix)}, **written})
        return sorted(written)


def write_batches(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """Append the rows in the order of their batch numbers, as an ordinary column.

    Files follow the number of rows, not of batches: ranges of batches, of which Spark joins small ones. Their
    statistics let a reader of some batches skip files and row groups.
    """
    ordered = df.repartitionByRange(column(batch)).sortWithinPartitions(column(batch))
    ordered.write.mode("append").parquet(path)


def read_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batches: Iterable[int] | None = None,
    batch: str = "batch_id",
) -> DataFrame:
    """All batches, or some; the choice reaches the scan, also where it is long."""
    df = spark.read.schema(schema).parquet(path)
    if batches is None:
        return df
    wanted = sorted(batches)
    if not wanted:
        return df.limit(0)
    return df.where(column(batch).between(wanted[0], wanted[-1]) & column(batch).isin(*wanted))


def export_csv(df: DataFrame, root: str, name: str, at: dt.datetime) -> str:
    """CSV with a header under `<name>_ajustada_<time>.csv`, without the landing suffix."""
    base = name.replace("_bruto", "")
    path = f"{root.rstrip('/')}/{base}_ajustada_{at.strftime('%Y%m%d_%H%M%S')}.csv"
    writer = df.write.option("header", True).option("encoding", "UTF-8").option("escape", '"')
    # Spark would trim values at both ends
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def import_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The reverse of `export_csv`; without a schema all columns are text."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
    reader = reader.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)
