"""Session helpers: one place for the defaults every job relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quillspark") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a private folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="quillspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir).

    An application's scratch folders lie together and go when its driver ends normally.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        atexit.register(_remove, spark.sparkContext._jvm, base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _remove(jvm, path: str) -> None:
    from py4j.protocol import Py4JError, Py4JNetworkError
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
    except (Py4JError, Py4JNetworkError, ConnectionError):
        pass  # the JVM has gone already; the folder stays for the operator of the cluster


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when it provably holds at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows; beyond the bound the frame is
    returned as is and the planner picks a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


_MATERIALIZED: dict[tuple[str, str, str], str] = {}
_MATERIALIZED_LOCK = threading.RLock()


def materialized(spark: SparkSession, name: str, source: str, write) -> str:
    """Path of a derived input written once per application under the shared folder.

    ``write(path)`` produces it on first use; later queries of the same application read
    the files, as they would read input that already sits in storage.
    """
    key = (spark.sparkContext.applicationId, name, source)
    with _MATERIALIZED_LOCK:  # two threads asking at once write it once
        path = _MATERIALIZED.get(key)
        if path is None:
            path = scratch_path(spark, name)
            write(path)
            _MATERIALIZED[key] = path
        return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quillspark`` importable in Python workers (once per application).

    Arrow batch functions are defined in this package and pickled by reference, so the
    workers import it. The package is zipped and added with ``SparkContext.addPyFile``,
    which serves it to every executor (what ``--py-files`` does at submit time). The zip
    is staged under the shared checkpoint folder when that is a local path; otherwise
    it is staged beside the driver only, which is all ``addPyFile`` reads.
    """
    import shutil

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else (base if base.startswith("/") else None)
    stage = os.path.join(local, "pyfiles", uuid.uuid4().hex) if local else tempfile.mkdtemp()
    os.makedirs(stage, exist_ok=True)
    archive = shutil.make_archive(os.path.join(stage, "quillspark"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir="quillspark")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
