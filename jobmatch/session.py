"""SparkSession set-up shared by tests, bench and scripts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew-join splits a hot partition.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "jobmatch", master: str | None = None,
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if spark_context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def spark_context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark_context(spark)
    if sc is not None:
        d = sc.getCheckpointDir()
        if d:
            return d
        return sc.getConf().get("spark.checkpoint.dir", None)
    return spark.conf.get("spark.checkpoint.dir", None)


def require_local(master: str) -> None:
    """Raise unless all tasks run in this process, which sees its own temporary folder."""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master!r} share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; set one only for a local master that names
    none (tests).  On a cluster a machine-local folder would lose rows, so an unset
    ``spark.checkpoint.dir`` is an error there."""
    d = checkpoint_dir(spark)
    sc = spark_context(spark)
    if not d:
        require_local(sc.master if sc is not None else "")
        d = tempfile.mkdtemp(prefix="jobmatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_ZIP: str | None = None
_SHIPPED: set = set()


def _package_zip() -> str:
    global _ZIP
    if _ZIP is None:
        import zipfile
        pkg = os.path.dirname(os.path.abspath(__file__))
        fd, path = tempfile.mkstemp(prefix="jobmatch-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _dirs, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
        _ZIP = path
    return _ZIP


def ship_package(spark: SparkSession) -> None:
    """Make ``jobmatch`` importable in every Python worker: the package is zipped once
    per driver process and added with ``addPyFile`` once per SparkContext (what
    ``--py-files`` does on a cluster); a Connect session gets it as an artifact."""
    sc = spark_context(spark)
    key = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    if sc is not None:
        sc.addPyFile(_package_zip())
    else:
        spark.addArtifacts(_package_zip(), pyfile=True)
    _SHIPPED.add(key)
