"""Helpers the operators of this subpackage share: lineage cuts, table reading and the record view."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_root(spark: SparkSession) -> str:
    """Folder all executors share, from ``spark.checkpoint.dir``. Where that is unset, a temporary one in local mode, as in tests; on a
    cluster the parts would lie on different machines, so it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="entitylink-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Stage:
    """Writes intermediate tables to the shared folder, which cuts lineage and survives the loss of executors.

    ``put`` replaces the table of the same name; ``drop`` deletes one; ``clear`` deletes all, once no result is read any more. The files are
    Parquet, so later steps read only the columns they use. All stages of an application lie in one folder named by its id.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.turn = 0

    def put(self, name: str, df: DataFrame) -> DataFrame:
        self.turn += 1
        path = f"{self.root}/{name}-{self.turn}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        old = self.paths.pop(name, None)
        if old:
            self._delete(old)

    def clear(self) -> None:
        self.paths.clear()
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers of a session, once; they may run where it isn't installed."""
    context = spark.sparkContext
    if getattr(context, "_entitylink_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="entitylink-")) / "entitylink.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    context.addPyFile(str(target))
    context._entitylink_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sides(live: DataFrame) -> DataFrame:
    """Both sides of every request as ``id, name, addr, first``, from one scan; ``first`` is 1 on the S1 side."""
    side = lambda of, first: F.struct(F.col(f"{of}_id").alias("id"), F.col(f"{of}_name").alias("name"), F.col(f"{of}_addr").alias("addr"), F.lit(first).alias("first"))
    return live.select(F.inline(F.array(side("s1", 1), side("cand", 0)))).filter(F.col("id").isNotNull())


def records(live: DataFrame, roles: bool = False) -> DataFrame:
    """One row ``id, name, addr`` per record id; a null where no request gives the value. With ``roles`` also ``as_s1, as_cand``: the sides it stands on.

    Repeated rows collapse map-side before the shuffle, so a record that holds a large share of the requests costs one
    row per input partition.
    """
    columns = ["id", "name", "addr", *["first"] * roles]
    distinct = sides(live).select(*columns).dropDuplicates(columns)
    stood = [(F.max("first") == 1).alias("as_s1"), (F.min("first") == 0).alias("as_cand")] if roles else []
    return distinct.groupBy("id").agg(F.max("name").alias("name"), F.max("addr").alias("addr"), *stood)
