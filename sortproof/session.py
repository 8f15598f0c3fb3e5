"""Session helpers: a local session for tests and benches, and the shared folder.

Library code never creates a session; it takes the caller's.  Intermediate
tables and written datasets go under ``spark.checkpoint.dir`` (the cluster's
shared folder).  Only when that is unset -- local runs and tests -- do we set
one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sortproof") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sortproof`` importable in the Python workers of a local application.

    Operators that run Python on executors (the generator, the record source,
    the run scanner) call this.  In local mode the package is zipped once per
    process and added with ``addPyFile``, so it works even when the driver was
    started outside the repository.  On a cluster, ship it the usual way
    (``--py-files`` / ``spark.submit.pyFiles``); nothing is written here then.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
        local = sc.master.startswith("local")
    except Exception:  # pragma: no cover - Spark Connect: ship with addArtifacts
        return
    if app in _SHIPPED or not local:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="sortproof-pyfiles-"), "sortproof.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``.

    Read from the session.  If unset in a local run, a fresh folder under the
    system temp dir is made and set, for both the conf and the context.  On a
    cluster a machine's own folder would not do: unset raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master.startswith("local[") or master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="sortproof-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # pragma: no cover - Spark Connect has no context
        pass
    return d


#: Tables made on the driver are broadcast up to this many bytes.
BROADCAST_BYTES = 64 << 20


def small_table(df: DataFrame, n_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its known size allows; a shuffle join is planned beyond."""
    return F.broadcast(df) if n_bytes <= BROADCAST_BYTES else df


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder (never reused between runs)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/sortproof-{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
