"""Session settings and shared scratch space."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings read at execution time; they are safe to leave on for the session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every reportlake job relies on."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``reportlake`` importable in the Python workers (what ``--py-files`` does).

    The few Arrow/pandas helpers (workbook parsing, per-partition numbering) are defined
    in this package, so workers must import it. Once per application the package is zipped
    into the shared checkpoint folder and added with ``addPyFile``; when that folder is not
    a local path the package is expected to be installed with the job (``--py-files``).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = checkpoint_root(spark)
    local = root[5:] if root.startswith("file:") else root
    if not local.startswith("/"):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    os.makedirs(local, exist_ok=True)
    zpath = f"{local}/reportlake-py-{app}-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, **conf: str):
    """Set SQL confs for the duration of a block (parse/analysis time) and restore them."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine (``local[...]``, as in tests) may do without: then one is created and
    registered. On a cluster a missing folder is an error, since a driver-local one can't be shared.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:  # ``spark.checkpoint.dir`` is a core setting: register a folder on the context instead
        root = tempfile.mkdtemp(prefix="reportlake-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A fresh directory under the shared checkpoint folder (never a machine-local temp dir)."""
    path = f"{checkpoint_root(spark)}/reportlake/{label}-{uuid.uuid4().hex[:12]}"
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


def new_local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reportlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
