"""Session helpers: one place that sets the knobs our plans rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "loanlens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    On a cluster the master and the checkpoint folder come from the cluster
    configuration; we only fill in what is unset (local runs and tests).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor (ignored if already running)
            builder = builder.config("spark.driver.memory", os.environ.get("LOANLENS_DRIVER_MEMORY", "16g"))
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.scheduler.mode", "FAIR")      # one pool unless a caller names others
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only a local master may run without ``spark.checkpoint.dir``: a scratch
    folder is then made.  On a cluster executors would not see it, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="loanlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def is_local(master: str) -> bool:
    """True if the driver's JVM runs all tasks (``local``, ``local[4]``), false for ``local-cluster``."""
    return master == "local" or master.startswith("local[")


def shared_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of replaying
    the plan, and Catalyst learns the real size for its join choice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "loanlens", name)


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there; false if it is.  Of several writers exactly one gets true.

    Local and mounted folders: a finished file is linked to its name, which
    fails if the name is taken.  Other stores: the file system's own create
    without overwrite, which Spark's Python API does not offer, so this branch
    goes through the driver's JVM and needs a classic session.
    """
    scheme, _, rest = path.partition("://") if "://" in path else ("file", "", path.removeprefix("file:"))
    if scheme == "file":
        os.makedirs(os.path.dirname(rest), exist_ok=True)
        part = f"{os.path.dirname(rest)}/_{uuid.uuid4().hex}"
        with open(part, "w") as f:
            f.write(text)
        try:
            os.link(part, rest)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    from py4j.protocol import Py4JJavaError
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = store.create(name, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True
