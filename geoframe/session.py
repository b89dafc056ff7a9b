"""Session helpers: configuration, shared scratch location, registration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "geoframe",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session configured the way the library expects.

    On a cluster call this without ``master`` so the deployment's settings win.
    """
    os.environ.setdefault("PYTHONPATH", _PACKAGE_ROOT)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    register(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only in a local session where nothing
    is configured a private folder is created; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # getCheckpointDir appends a per-application uuid folder
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="geoframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (URI scheme kept)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme; other schemes are returned unchanged."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Make ``geoframe`` importable in the executors' Python workers: the
    package is zipped once on the driver and distributed with
    ``SparkContext.addPyFile`` (Spark's own file distribution)."""
    sc = spark.sparkContext
    if getattr(sc, "_geoframe_shipped", False):
        return
    import uuid
    import zipfile
    pkg = os.path.join(_PACKAGE_ROOT, "geoframe")
    shared = checkpoint_dir(spark)
    if shared.startswith("file:") or "://" not in shared:
        # the shared folder is a POSIX path: keep the archive there
        out_dir = os.path.join(local_path(shared), "geoframe-pkg", uuid.uuid4().hex)
        os.makedirs(out_dir, exist_ok=True)
    else:
        # remote shared storage: Spark ships the driver's file itself
        out_dir = tempfile.mkdtemp(prefix="geoframe-pkg-")
    zpath = os.path.join(out_dir, "geoframe.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, _PACKAGE_ROOT))
    sc.addPyFile(zpath)
    sc._geoframe_shipped = True


def register(spark: SparkSession) -> None:
    """Register the ``filegdb`` source and the SQL geometry functions, and
    ship the package to the executors."""
    from geoframe.functions.geometry import register_sql_functions
    from geoframe.sources.filegdb import FileGDBDataSource

    ship_package(spark)
    sc = spark.sparkContext
    key = id(spark)
    if key in _REGISTERED:
        return
    # once for the session: readers with ``pushdown`` need it, others ignore it
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FileGDBDataSource)
    register_sql_functions(spark)
    _REGISTERED.add(key)


_REGISTERED: set[int] = set()
