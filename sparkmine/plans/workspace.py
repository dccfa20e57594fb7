"""Session set-up and intermediate tables.

Loops cut their lineage by writing a parquet table to the shared folder that
the cluster names in ``spark.checkpoint.dir``. A written table survives the
loss of any executor, keeps column pruning, and gives the next step a size
that adaptive execution can plan with.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime settings every operator relies on. They are session settings a user
# may override; none changes a result.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "sparkmine", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The shared scratch folder. A temporary folder is used only on a local
    master with no folder configured, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="sparkmine-")
            context.setCheckpointDir(_local_roots[context.applicationId])
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared scratch folder."""
    return f"{work_root(spark)}/sparkmine/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written table. Another schema may name
    a user type for what it is stored as."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more. Other
    folders stay."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        ours = spark._jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/sparkmine")
        if path.getParent().toUri().getPath() == ours.toUri().getPath():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a source with fewer partitions than cores over all
    cores; a source with enough of them is left as it is."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
