"""Session helpers: a tuned local session for tests and the shared work folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitchside") -> SparkSession:
    """A local session with AQE on and the web UI off (used by tests and the bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster this must be a shared folder named in ``spark.checkpoint.dir``;
    only a local-mode session without one gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pitchside-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "pitchside", *parts])


def stable_key(*parts: str) -> str:
    return hashlib.sha1("\x1f".join(parts).encode()).hexdigest()[:16]


def materialize(df: DataFrame, path: str, build=None, schema=None) -> DataFrame:
    """Write ``df`` as a new parquet table beside ``path`` and read it back.

    Each call writes a fresh folder, and its name is known only once the job has
    succeeded, so what a failed or half-finished write left behind is never read.
    Writing a table (rather than caching) cuts the lineage durably: a lost
    executor re-reads files instead of recomputing the plan, and later scans
    still get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    fresh = f"{path}-{uuid.uuid4().hex[:12]}"
    out = build(df) if build is not None else df
    out.write.parquet(fresh)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(fresh)
