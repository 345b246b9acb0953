"""What depends on the running session: the shared folder and reading of tables."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder of parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share and which survives their loss.

    Only where the session names no folder (tests on one machine) a local one is set, which goes with the process.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="chatframe-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def tasks(spark: SparkSession) -> int:
    """The number of tasks of a shuffle whose work is heavier than its data, which adaptive coalescing can't know."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many tasks as there are cores, for work that is heavier than its data; usually df itself.

    Only plans that read and project are looked at: asking a plan with a shuffle for its partitions would run it.
    """

    def nodes(plan):
        yield plan.nodeName()
        below = plan.children()
        for i in range(below.size()):
            yield from nodes(below.apply(i))

    if any(re.search("Exchange|Aggregate|Join|Window|Sort|Limit|CartesianProduct", n) for n in nodes(df._jdf.queryExecution().sparkPlan())):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for the functions that run in Python workers there."""
    sc = spark.sparkContext
    if not getattr(sc, "_chatframe_shipped", False):
        here = os.path.dirname(os.path.abspath(__file__))
        with tempfile.TemporaryDirectory() as staging:
            kept = os.path.join(tempfile.mkdtemp(prefix="chatframe-"), "chatframe_package")
            shutil.copytree(here, os.path.join(staging, "chatframe"), ignore=shutil.ignore_patterns("__pycache__"))
            sc.addPyFile(shutil.make_archive(kept, "zip", staging))
        sc._chatframe_shipped = True
