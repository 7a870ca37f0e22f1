"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library relies on; cluster-level sizing (executor
# memory, shuffle partitions for the real data volume) belongs to spark-submit.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def limit_generated_methods(spark: SparkSession) -> None:
    """Let no generated method exceed 8000 bytes, the size from which HotSpot never compiles one.

    The rows of the job have about 40 columns.  With Spark's default limit (65535) a fused stage
    over them is interpreted for every row; under this limit Spark runs its operators one by one,
    in methods that are compiled.  Set on the session, as the plan runs after it is built; a lower value stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > int(RECOMMENDED_CONF[name]):
        spark.conf.set(name, RECOMMENDED_CONF[name])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlint", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC; a checkpoint folder of its own if none is given)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="ledgerlint-"))
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set and the master is local (tests) is a fresh temporary
    folder created and registered; on a cluster an unset value is an error,
    because a machine-local folder is not visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    d = tempfile.mkdtemp(prefix="ledgerlint-")
    if sc is not None:
        sc.setCheckpointDir(d)
        # setCheckpointDir adds a per-application sub-folder; use what Spark reports.
        return (sc.getCheckpointDir() or d).rstrip("/")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the shared folder."""
    return f"{ensure_shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
