"""Access to the tables and settings shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.plans.workspace import configure, materialize

# Documents can be long, so batches handed to Python are bounded in rows and bytes.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_place() -> Column:
    """Names a row of a table that is read straight from Parquet files: its file
    and its number there, however the files are split."""
    return F.struct("_metadata.file_path", "_metadata.row_index")


def placed(docs: DataFrame, place: Column | None) -> tuple[DataFrame, Column, list[Column]]:
    """The documents, an expression that names each of their rows the same in
    every scan, and their columns. Without such an expression a numbered copy
    is written."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    if place is not None:
        return docs, place, names
    number = "row_number"
    while number in docs.columns:
        number += "_"
    return materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered"), F.col(number), names
