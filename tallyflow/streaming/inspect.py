"""State of a stream, read as a table from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def held_keys(spark: SparkSession, path: str, variable: str, operator: int = 0) -> DataFrame:
    """Live keys and values of a state variable of a processor, as of the last committed batch."""
    reader = spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", variable).option("operatorId", operator)
    return reader.load()


def batches_run(spark: SparkSession, path: str) -> DataFrame:
    """One row per operator: the batches its state can be read for."""
    return spark.read.format("state-metadata").load(f"{path}/checkpoint").select("operatorId", "operatorName", "minBatchId", "maxBatchId")
