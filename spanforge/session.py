"""Session helpers: a tuned builder, the shared checkpoint folder, the broadcast bound."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest dimension table (bytes) we allow to be broadcast.  Dictionaries, label maps,
# exclusion lists and per-partition offset tables are far below it.
BROADCAST_MAX_BYTES = 64 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "spanforge",
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE on, UI off and UTC time; used by tests and the bench."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a fresh scratch folder (tests, bench);
    on a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="spanforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and reread it: computed once,
    lineage cut, readable after an executor is lost."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(known_bytes: int | None) -> bool:
    """Whether a table of at most ``known_bytes`` (None: unknown) may be broadcast."""
    return known_bytes is not None and known_bytes <= BROADCAST_MAX_BYTES


def spread(scan: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal the rows of a file scan over the cluster's cores when it yields fewer partitions.

    Text cleaning is CPU-bound; a table stored as one large row group would otherwise be
    cleaned by one task.  Large inputs already have many splits and pass unchanged.
    """
    target = min_partitions or scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(target) if scan.rdd.getNumPartitions() < target else scan


def local_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A driver-side table as a local relation, sent as one Arrow table: no Python worker
    scans it, and the plan does not grow with its rows."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    names = st.names
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], to_arrow_schema(st))
    return spark.createDataFrame(table, st)
