"""Session construction and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every regioncast job relies on.  AQE re-plans joins on measured
# shuffle sizes (a small side becomes a broadcast only once its real size is
# known to be under the threshold), coalesces small shuffle partitions and
# splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a table stored in buckets of some of the join keys is joined in place
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "regioncast",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the regioncast defaults.

    On a cluster leave ``master`` unset (spark-submit provides it) and size
    ``shuffle_partitions`` to the data: about one partition per 128-256 MB
    of shuffled bytes; AQE then coalesces what turns out to be too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Executors of a cluster do not see each other's disks, so a session
    without a shared folder is an error there.  Only a local session (tests),
    whose executors run in the driver, gets a temporary folder of its own.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc is not None else None)
    if not base:
        if not (sc and re.match(r"local(\[|$)", sc.master)):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="regioncast-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    That folder is visible to every executor, so written tables and
    checkpoints there survive the loss of any one machine.
    """
    name = "/".join(parts) if parts else "work"
    return f"{checkpoint_base(spark)}/regioncast/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, keeping a configured folder."""
    checkpoint_base(spark)
