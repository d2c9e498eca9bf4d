"""Session construction and shared-folder helpers.

Cluster settings (s3a endpoint and keys, checkpoint dir, executor sizing)
come from the cluster's own configuration; this module only fills in
defaults that are unset, which is what local tests need.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only when the key is not already set on the builder or
# cluster. AQE re-plans joins from runtime sizes (broadcast only when the
# measured side is small) and splits skewed shuffle partitions.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# Object-store connector settings read from the environment, set on the
# builder (never inside job code).
_S3A_ENV = {
    "spark.hadoop.fs.s3a.endpoint": "S3_ENDPOINT_URL",
    "spark.hadoop.fs.s3a.access.key": "AWS_ACCESS_KEY_ID",
    "spark.hadoop.fs.s3a.secret.key": "AWS_SECRET_ACCESS_KEY",
}


def build_session(master: str | None = None, app: str = "loomstat",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    for k, env in _S3A_ENV.items():
        if os.environ.get(env):
            b = b.config(k, os.environ[env])
    if any(os.environ.get(e) for e in _S3A_ENV.values()):
        b = b.config("spark.hadoop.fs.s3a.path.style.access", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``loomstat`` importable in executor Python workers.

    pandas UDFs and ``applyInPandas`` functions live in this package; on a
    cluster the executors do not have the source tree, so the package is
    zipped once per session and handed to ``addPyFile`` (Spark distributes
    it with the job).
    """
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_loomstat_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="loomstat-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._loomstat_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is. Only
    when it is unset (local tests) do we pick a fresh local folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="loomstat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if getattr(sc, "_loomstat_checkpoints", None) != d:  # each call would open a new sub-folder
        sc.setCheckpointDir(d)
        sc._loomstat_checkpoints = d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
