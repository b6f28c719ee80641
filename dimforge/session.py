"""Session helpers.

The library never creates machine-local scratch space on a cluster: lineage cuts and
intermediate tables go below ``spark.checkpoint.dir`` as configured by the cluster.
Only when that setting is absent (local runs, tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# The folder of each local application whose session names none.
_FALLBACK: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "dimforge") -> SparkSession:
    """Session for tests and the local bench (UI off, AQE on, UTC)."""
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
        .config("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
    )
    event_log = os.environ.get("DIMFORGE_EVENT_LOG")  # stage/task times for profiling runs
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. If the cluster did not name one
    (local mode, tests), a fresh folder under the system temp dir serves the application; the
    setting itself cannot be changed at run time.
    """
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if conf:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf)
        return conf.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _FALLBACK:
        return _FALLBACK[app]
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        # setCheckpointDir appends a random sub-folder; use its parent as root
        return existing.rstrip("/").rsplit("/", 1)[0]
    if not re.match(r"local($|\[)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set: on a cluster it must name a shared, reliable folder "
            "(HDFS/object store); machine-local scratch space is not safe when executors are lost."
        )
    _FALLBACK[app] = tempfile.mkdtemp(prefix="dimforge-ckpt-")
    spark.sparkContext.setCheckpointDir(_FALLBACK[app])
    return _FALLBACK[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root (never reused, never deleted here)."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Hands this package to Python workers that do not have it on their path (once per application).

    Functions of mapInArrow and the like are pickled by reference, so workers import the package; an archive
    of it goes to all executors through Spark's own file distribution.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import shutil

    here = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='dimforge-py-')}/{os.path.basename(here)}", "zip", os.path.dirname(here), os.path.basename(here))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def cluster_conf(input_bytes: int, total_cores: int, target_bytes: int = 256 << 20, max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Settings for a large cluster run, sized from the raw input volume.

    * scan splits of ``target_bytes`` (tasks ~ input / 256 MB);
    * initial shuffle partitions from the volume that is actually shuffled: the big
      shuffles here carry keys or pre-aggregated rows (ids for uniqueness tests, partial
      aggregates), roughly 1/8 of the input at most; AQE coalesces them down to
      ``advisoryPartitionSizeInBytes`` and splits skewed ones (> 5x median and > target);
    * wall-clock timestamps (NTZ) and ANSI casts, as the warehouse expects.
    Broadcasts are decided by our own row-count checks, so Spark's estimate-based
    auto-broadcast keeps its default.
    """
    n_shuffle = int(max(2 * total_cores, min(input_bytes // (8 * target_bytes), max_shuffle_partitions)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n_shuffle),
        "spark.sql.shuffle.partitions": str(n_shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_bytes),
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    }
