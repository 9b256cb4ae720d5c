"""Session settings the operators rely on, and the shared folder for tables jobs write."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Settings that operators rely on: times without an offset mean UTC, of a key given twice in one
#: JSON object the last one counts, a rank limit of any size is applied before the shuffle, and a
#: scan gets up to 1000 keys it is asked for by name.
RUNTIME_CONF = {
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator assumes to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "packetflow", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with adaptive execution; on a cluster, leave ``master`` to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a folder
    of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="packetflow-")
    context.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below :func:`shared_dir` for one run of one job."""
    return f"{shared_dir(spark)}/packetflow/{name}-{uuid.uuid4().hex}"


#: Keeps checkpoints by plain renames, as Spark does wherever a store has nothing else.
PLAIN_CHECKPOINTS = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)

#: Files of this machine without a checksum file beside each: the usual ones start several processes
#: for every file they write, to set the permissions of it and of its checksums; these start one.
PLAIN_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}

#: Logs of a stream keep the last few micro-batches: folders of logs are listed in every one, so if
#: none were deleted, each would cost more than the one before it. A restart needs the last two.
FEW_LOGS = {
    "spark.sql.streaming.minBatchesToRetain": "10",
    "spark.sql.streaming.fileSource.log.cleanupDelay": "1s",
    "spark.sql.streaming.fileSink.log.cleanupDelay": "1s",
}


def plain_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Options for many small files below ``path``; none if it is no folder of this machine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return PLAIN_FILES if store.getUri().getScheme() == "file" else {}


def short_batches(spark: SparkSession, path: str) -> SparkSession:
    """A session for streams below ``path`` that run thousands of short micro-batches.

    Folders are listed by as many tasks as there are cores instead of a task each. Where ``path`` is
    a folder of this machine, logs of a checkpoint are plain files put in place by plain renames:
    the usual ones start a dozen processes for each log there, which cost more than the micro-batch
    itself. Logs that are merged go at once, so a sink must not be read while it is written. Plans,
    which are told to listeners batch by batch, are told in short.
    """
    session = prepare(spark.newSession())
    cores = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(cores))
    session.conf.set("spark.sql.ui.explainMode", "simple")
    plain = plain_files(spark, path)
    if plain:
        plain = plain | {"spark.sql.streaming.checkpointFileManagerClass": PLAIN_CHECKPOINTS}
    for key, value in (FEW_LOGS | plain).items():
        session.conf.set(key, value)
    return session


@contextlib.contextmanager
def bare_settings(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, Hadoop's settings go to tasks without the names of the files they come from.

    Every scan and every write sends all settings, a thousand, and packs the names beside each by
    themselves, at ten times the cost of the settings: much to a short micro-batch, and stages are
    packed one after the other. Only a listing of settings reads the names, which come back in the
    end. Where they can not be left out, they are sent.
    """
    settings, names, held = spark._jsc.hadoopConfiguration(), None, None
    with contextlib.suppress(Py4JJavaError):
        settings.size()  # else they may not be loaded yet
        kind = spark._jvm.org.apache.hadoop.conf.Configuration(False).getClass()
        field = kind.getDeclaredField("updatingResource")
        field.setAccessible(True)
        names = field.get(settings)
    if names is not None:
        held = spark._jvm.java.util.HashMap(names)
        names.clear()
    try:
        yield
    finally:
        if names is not None:
            names.putAll(held)


@contextlib.contextmanager
def plain_caches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile, what is persisted is kept as it is: to compress it costs as much as to parse it."""
    name = "spark.sql.inMemoryColumnarStorage.compressed"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on a source of fewer splits than cores, such as one small file.

    A source with enough splits, which any large one has, is left as it is: no shuffle. ``keys``
    identify a row, so the pieces are even and the same when a task is run again.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run jobs that do not need each other at the same time; the results in order.

    Small jobs leave cores idle one by one. All are ended before an error of one is raised.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [future.result() for future in futures]
