"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import hashlib
import tempfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings for a large cluster (pass to spark-submit --conf).  AQE sizes the
# shuffle partitions at run time and splits skewed join partitions; the
# cleaner removes the thin checkpointed tables once they are unreferenced.
# Besides these a cluster must name a shared folder in spark.checkpoint.dir.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tunnelscan") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Where it is
    unset, a local session (as in tests) gets a private folder; on a cluster
    executors could not see one, so that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is not None:
        # setCheckpointDir adds a random child; its parent is the shared root.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not is_local(sc.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tunnelscan-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set(CHECKPOINT_CONF, local)
    return local


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[8]``)."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root, "tunnelscan", *parts])


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return bool(fs.exists(jpath))


def publish(spark: SparkSession, tmp: str, final: str) -> bool:
    """Atomically move a finished output into place (False if another run won).

    ``FileContext.rename`` fails where the target exists; ``FileSystem.rename``
    would move the source inside it."""
    jvm = spark.sparkContext._jvm
    _, src = _hadoop_path(spark, tmp)
    fs, dst = _hadoop_path(spark, final)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(src), fs.makeQualified(dst), options)
    except Py4JJavaError:
        if not fs.exists(dst):
            raise
        return False
    return True


def hidden_sibling(path: str, suffix: str) -> str:
    """A path beside ``path`` that readers of their common folder skip."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}.{suffix}"


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _hadoop_path(spark, path)
    fs.delete(jpath, True)


def replace_folder(spark: SparkSession, tmp: str, final: str) -> None:
    """Put a finished output in the place of an older one, if any.

    The old folder is set aside, the new one renamed into place, then the old one
    removed.  A job that dies before that leaves the old output as it was; one that
    dies between the two renames leaves it aside, from where ``restore_folder``
    takes it back."""
    aside = hidden_sibling(final, "old")
    if path_exists(spark, final):
        remove(spark, aside)
        if not publish(spark, final, aside):
            raise FileExistsError(f"{aside} appeared while {final} was replaced: another run writes it")
    if not publish(spark, tmp, final):
        raise FileExistsError(f"{final} appeared while it was replaced: another run writes it")
    remove(spark, aside)


def restore_folder(spark: SparkSession, final: str) -> bool:
    """Take an output back that a run set aside and did not replace."""
    aside = hidden_sibling(final, "old")
    return not path_exists(spark, final) and path_exists(spark, aside) and publish(spark, aside, final)


def fingerprint(spark: SparkSession, *files: str, salt: str = "") -> str:
    """Stable id of input files (path, size, time of change) for staged derived
    tables, read through the file system that Spark reads them with."""
    h = hashlib.sha1(salt.encode())
    for f in files:
        fs, path = _hadoop_path(spark, f)
        found = []
        if fs.exists(path):
            status = fs.getFileStatus(path)
            listed = fs.listStatus(path) if status.isDirectory() else [status]
            found = sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in listed)
        h.update(f"{fs.makeQualified(path)}|{found}".encode())
    return h.hexdigest()[:16]
