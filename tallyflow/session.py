"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "tallyflow", **conf: str) -> SparkSession:
    """Session for jobs, tests and benches; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A machine-local folder is made only on a local master with the setting absent (tests), once per application; it goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = tempfile.mkdtemp(prefix="tallyflow-")
        atexit.register(shutil.rmtree, _made[app], ignore_errors=True)
    return _made[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df, name: str):
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
