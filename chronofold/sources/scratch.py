"""The shared folder for intermediate results."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the checkpoint directory already set.

    Only a local session without either gets a temporary folder; on a cluster that would be
    lost with its machine, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="chronofold-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses, below the folder of this run."""
    return f"{_run_of(spark)['folder']}/{label}-{uuid.uuid4().hex}"


def new_schema(spark: SparkSession, label: str) -> str:
    """A schema for tables that last until the run ends, in the run's folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{new_folder(spark, label)}'")
    _run_of(spark)["schemas"].append(name)
    return name


# By application: the folder of its scratch data, and the schemas made for it.
_RUNS: dict[str, dict] = {}


def _run_of(spark: SparkSession) -> dict:
    application = spark.sparkContext.applicationId
    if application not in _RUNS:
        folder = f"{shared_folder(spark).rstrip('/')}/run-{application}-{uuid.uuid4().hex}"
        _RUNS[application] = {"folder": folder, "schemas": []}
    return _RUNS[application]


def end_run(spark: SparkSession) -> None:
    """Remove all that this application left in the shared folder, and its schemas.

    Call it when the results have been written elsewhere: relations that ``freeze`` returned, and
    what was built on them, can't be read afterwards.
    """
    run = _RUNS.pop(spark.sparkContext.applicationId, None)
    if run is None:
        return
    for schema in run["schemas"]:
        spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")
    path = spark._jvm.org.apache.hadoop.fs.Path(run["folder"])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame) -> DataFrame:
    """A relation written once to the shared folder, fixed whatever happens to its inputs.

    Use it on a change batch that is expensive, or that could differ when read twice. The
    copy is columnar, so a later reader that needs only the keys reads only those, and it
    does not depend on any executor. ``end_run`` removes it.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "frozen")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
