"""What a session needs to run this package on executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, spark.checkpoint.dir. Where it is unset (tests, one
    machine) a folder of its own is made, set, and removed at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="lexiloom-")
        atexit.register(shutil.rmtree, folder, True)
        root = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def workplace(spark: SparkSession) -> str:
    """A new folder under the shared folder, which goes when the application ends."""
    folder = f"{shared_root(spark)}/tables-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return folder


def written(spark: SparkSession) -> Callable[[DataFrame, str], DataFrame]:
    """``put(df, name)``: writes a table in a folder of this call under the shared folder, and reads it."""
    folder = workplace(spark)

    def put(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    return put


def spread(df: DataFrame) -> DataFrame:
    """Deals rows out anew where the input has fewer partitions than the cluster has cores (a few small
    files, say); inputs of many splits stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_lexiloom_shipped", False):
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lexiloom-code-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(f"{folder}/{top.name}.zip", "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(f"{folder}/{top.name}.zip")
    context._lexiloom_shipped = True
