"""Session settings and the shared folder that checkpoints and scratch tables use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Everything here is an ordinary Spark setting; a cluster may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # one-row aggregates over wide tables have many fields; keep them generated
    "spark.sql.codegen.maxFields": "1000",
    # checkpoints whose tables are no longer in use are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "proofline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    named = named or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    named = tempfile.mkdtemp(prefix="proofline-")
    # nobody else knows this folder, so it goes with the process
    atexit.register(shutil.rmtree, named, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read from there on.

    The copy outlives lost executors, so partition numbers recorded in it stay valid, and
    later reads take only the columns they need. Names are kept apart from the file, which
    could not hold such as differ in case alone; the metadata of columns stay.
    """
    path = scratch_path(df.sparkSession, "kept")
    fields = df.schema.fields
    plain = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    if any(_unwritable(f.dataType) for f in fields):
        return _checkpointed(df)
    df.toDF(*plain.names).write.parquet(path)
    back = df.sparkSession.read.schema(plain).parquet(path)
    return back.select(*[F.col(f"c{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(fields)])


def _unwritable(kind: T.DataType) -> bool:
    """Types that Parquet has no form for."""
    if isinstance(kind, T.ArrayType):
        return _unwritable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _unwritable(kind.keyType) or _unwritable(kind.valueType)
    if isinstance(kind, T.StructType):
        names = [f.name.lower() for f in kind]
        return not names or len(set(names)) < len(names) or any(_unwritable(f.dataType) for f in kind)
    return isinstance(kind, (T.NullType, T.CalendarIntervalType))


def _checkpointed(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
