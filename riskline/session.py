"""Spark session helpers.

Cluster jobs get their session from the platform; these helpers only fill in settings
that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on (zone-free micros, AQE re-planning).
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",     # JSON bodies: the last of repeated keys counts
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riskline") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("RISKLINE_DRIVER_MEMORY", "16g"))
    )
    for k, v in _REQUIRED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the package's required SQL settings to an existing session and make the
    package importable by the Python workers (pandas UDFs, mapInPandas)."""
    for k, v in _REQUIRED.items():
        if k == "spark.sql.execution.arrow.pyspark.enabled":
            continue
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Zip this package once per application on the driver and hand it to Spark with
    ``addPyFile``; Spark itself distributes the file to the executors, so the checkpoint
    folder may be on any file system."""
    import hashlib
    import zipfile

    sc = spark.sparkContext
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(pkg) for f in fs
                   if f.endswith(".py"))
    if sc.applicationId in _SHIPPED:
        return
    digest = hashlib.sha1(b"".join(open(f, "rb").read() for f in files)).hexdigest()[:12]
    folder = tempfile.mkdtemp(prefix="riskline-pkg-")
    zpath = os.path.join(folder, f"riskline-{digest}.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for f in files:
            z.write(f, os.path.relpath(f, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED[sc.applicationId] = zpath


def is_local(spark: SparkSession) -> bool:
    """True if driver and executors are one process (``local``, ``local[n]``)."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session with a local master (a test run) gets a folder of its own when the
    setting is missing; on a cluster executors could not see such a folder, so the missing
    setting is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(configured)
        return configured
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                         f"executors share (master is {sc.master})")
    local = tempfile.mkdtemp(prefix="riskline-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/riskline/{name}"


def written(df, name: str):
    """Write ``df`` below the shared checkpoint folder and read it back: cuts the lineage
    with a table that survives lost executors (values that depend on the partitioning, such
    as generated ids, stay fixed) and that later readers can prune."""
    import uuid

    path = checkpoint_path(df.sparkSession, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
