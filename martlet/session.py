"""Session construction and the shared scratch location.

The job never invents a machine-local scratch folder when it runs on a cluster:
it reads ``spark.checkpoint.dir`` (the shared folder the cluster names) and only
sets its own when that is unset, which is the case in tests and local runs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for correctness and scale; submit-time config wins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "martlet",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session from a key/value config (operator C2).

    An existing active session is returned as is, so library code can be used
    from inside a job that already configured its own session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Unset, a local run gets a folder of its
    own; on a cluster it is an error, as executors don't share local folders."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect): config only
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="martlet-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for ``name``.

    Used for staged publishes, model files and round-trip scans, so that every
    executor and the driver see the same location.
    """
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base.rstrip("/"), "martlet", f"{name}-{uuid.uuid4().hex[:12]}")
    for scope in _SCOPES[-1:]:
        scope.append(path)
    return path


#: Rows of a file of staged wide text tables: about 100 MB at 200 columns, so that later reads spread.
WIDE_ROWS = 150_000
#: Paths given out inside each open ``scratch``, the innermost last.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes at its end what was staged inside, but for the frames in the list that it
    gives: for a step whose results are written whole before it ends."""
    kept: list[DataFrame] = []
    _SCOPES.append([])
    try:
        yield kept
    finally:
        stay = {staged_path(df) for df in kept}
        for path in _SCOPES.pop():
            if path not in stay:
                delete_path(spark, path)
            elif _SCOPES:
                _SCOPES[-1].append(path)


def staged_path(df: DataFrame) -> str | None:
    return getattr(df, "_martlet_staged", None)


def stage(df: DataFrame, name: str, **write_options) -> DataFrame:
    """``df`` written once under the shared folder and read back, so that several
    consumers don't compute it again. ``unstage`` deletes it."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**write_options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._martlet_staged = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete what ``stage`` wrote for a frame that nothing reads any more."""
    path = staged_path(df)
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of whatever file system ``path`` names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
