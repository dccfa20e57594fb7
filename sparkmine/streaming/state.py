"""Small state tables kept beside a streaming query.

Two folders take turns: batch ``n`` reads what batch ``n - 1`` wrote and
overwrites the other folder, so a batch that is run again after a failure
starts from the same state and leaves the same state. A table's rows carry
their batch number. The query's own checkpoint lies in the same place, which
ties the batch numbers to the tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

TRIGGER = "10 seconds"  # fixed value: batch interval of a running stream


def _folder(path: str, name: str, batch_id: int) -> str:
    return f"{path}/{name}-{batch_id % 2}"


def read(spark: SparkSession, path: str, name: str, batch_id: int, schema: str) -> DataFrame:
    """Rows that batch ``batch_id`` wrote to table ``name``; none before the
    first batch. State that a batch must have left and that cannot be read
    stops the stream: going on from nothing would lose all earlier posts."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, batch_id BIGINT").parquet(_folder(path, name, batch_id))
    held = rows.agg(F.max("batch_id")).first()[0]
    if held is not None and held != batch_id:
        raise RuntimeError(f"{path}: {name} holds batch {held}, not {batch_id}")
    return rows.drop("batch_id")


def schema_of(spark: SparkSession, path: str, name: str, batch_id: int) -> str:
    """Columns of table ``name`` as batch ``batch_id`` left it."""
    fields = spark.read.parquet(_folder(path, name, batch_id)).drop("batch_id").schema.fields
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)


def write(df: DataFrame, path: str, name: str, batch_id: int) -> None:
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).coalesce(1)
    rows.write.mode("overwrite").parquet(_folder(path, name, batch_id))


def last_batch(spark: SparkSession, path: str, name: str) -> int:
    """Number of the last batch that wrote table ``name``, or -1."""
    found = -1
    for turn in (0, 1):
        try:
            rows = spark.read.schema("batch_id BIGINT").parquet(_folder(path, name, turn))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = max(found, rows.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0])
    return found


def start(stream: DataFrame, path: str, on_batch, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": TRIGGER}
    return (
        stream.writeStream.option("checkpointLocation", f"{path}/checkpoint")
        .foreachBatch(on_batch)
        .trigger(**trigger)
        .start()
    )


def to_console(df: DataFrame, batch_id: int) -> None:
    """Print a small result of a batch."""
    print(f"batch {batch_id}")
    df.show(truncate=False)
