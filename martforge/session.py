"""Session helpers.

The library never builds its own cluster session: callers pass a
``SparkSession``.  ``local_session`` exists for tests and ``bench.py``;
``tune`` applies the runtime SQL settings the plans are designed around
(adaptive execution, skew-join splitting) and ``shared_dir`` resolves the
shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on.  All are session-scoped and safe
# to set on a shared cluster session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one extra exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def put_back(spark: SparkSession) -> None:
    """The settings that ``layout.size_shuffles`` replaced for an earlier query."""
    for k, v in getattr(spark, "_martforge_sized", {}).items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)
    spark._martforge_sized = {}


def tune(spark: SparkSession) -> SparkSession:
    put_back(spark)
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    ship(spark)
    return spark


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Writes made meanwhile delete their shuffle files once they end.  Otherwise these stay
    until the driver happens to collect garbage, and a run of many writes holds the sum of
    all their shuffles on disk, not the largest."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once per context, so that Python
    functions run wherever the driver was started from."""
    sc = spark.sparkContext
    if getattr(sc, "_martforge_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="martforge-ship-"), "martforge.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)   # served to the workers by the driver
    sc._martforge_shipped = True


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "martforge") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # drop checkpoint files once their DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        d = None
    return d or None


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """Folder under the cluster's shared ``spark.checkpoint.dir``.

    When the session names no checkpoint folder (local tests), one is
    created under the system temp folder and registered, so later
    ``checkpoint()`` calls and scratch tables land in the same place.
    With ``name`` a fresh, unique sub-folder path is returned (not created:
    Spark writers create it).
    """
    root = _checkpoint_dir(spark)
    if root is None:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share "
                               f"(master {master!r} is not local)")
        root = tempfile.mkdtemp(prefix="martforge-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # Spark Connect: remember it as a session conf
            try:
                spark.conf.set("spark.checkpoint.dir", root)
            except Exception:
                pass
    if name is None:
        return root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count as a number (falls back to
    the cluster's cores when the setting is not a plain integer)."""
    raw = spark.conf.get("spark.sql.shuffle.partitions", "200")
    try:
        return max(1, int(raw))
    except ValueError:
        try:
            return max(1, spark.sparkContext.defaultParallelism)
        except Exception:
            return 200
