"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the engine relies on. AQE re-plans joins and
# aggregations from runtime sizes (coalescing small partitions, splitting
# skewed ones); RocksDB keeps streaming join state off the JVM heap, and with
# changelog checkpointing a micro-batch uploads only its changes instead of
# snapshot files of a join state that only grows.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "boardwalk", **conf) -> SparkSession:
    """A session with the engine's settings. On a cluster pass no master and
    let ``spark-submit`` decide; locally pass ``local[N]``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


_MB = 1024 * 1024


def scale_settings(input_bytes: int, shuffled_fraction: float = 0.25, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings sized to the data, for a batch job on a cluster.

    AQE can coalesce shuffle partitions but not split them (skewed join
    partitions aside), so the initial count must make every partition fit in
    executor memory: one per ``target_partition_mb`` of *shuffled* bytes,
    which after column pruning and partial aggregation are a fraction of the
    input (``shuffled_fraction``; about a quarter for the board, whose joins
    move a few columns of each table). Map x reduce shuffle blocks grow with
    the square of the count: raise the target with the input. Scans split
    files into pieces of the target; a join partition is skewed at four times
    that."""
    shuffled = int(input_bytes * shuffled_fraction)
    target = f"{target_partition_mb}m"
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffled // (target_partition_mb * _MB)))),
        "spark.sql.files.maxPartitionBytes": target,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


# Settings a stream needs whatever the caller's session says.
STREAM_CONF = {k: v for k, v in ENGINE_CONF.items() if ".streaming." in k}


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streams: the caller's settings, state in RocksDB, and a
    number of state partitions of its own. That number is one task each per
    trigger and stays for the life of a checkpoint, so it goes by the cores
    (the default: as many) and by the state expected, not by what a batch job
    would shuffle. The caller's settings are never changed."""
    s = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if s.conf.isModifiable(k):
            s.conf.set(k, v)
    for k, v in STREAM_CONF.items():
        s.conf.set(k, v)
    s.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return s


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. On a cluster this
    is set by the deployment; only when it is unset (local tests) does this
    create a local folder and register it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) on a cluster")
        d = tempfile.mkdtemp(prefix="boardwalk-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder: later readers
    neither recompute it nor depend on the executors that made it."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:  # the setting was made after the start
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def working_folder(spark: SparkSession, kind: str) -> str:
    """A new name for a folder of this application below the shared one."""
    return f"{_own(spark)}/{kind}-{uuid.uuid4().hex}"


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/boardwalk/{spark.sparkContext.applicationId}"


def clear_working_folders(spark: SparkSession) -> None:
    """Removes what this application has stored for itself: staged feeds, stored
    boards, replayed tables. Results that read them are gone with them, so call
    it last. Checkpoints of DataFrames go as the driver lets go of them
    (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    delete_path(spark, _own(spark))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on any Hadoop file system; [] if absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def modified_ms(spark: SparkSession, path: str) -> int | None:
    """When a file was last changed; None if it isn't there."""
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime()) if fs.exists(p) else None


def file_times(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files of a folder (the immediate ones) and when each was written,
    in ms by the store's clock; a folder that is not there has none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    found = {s.getPath().getName(): int(s.getModificationTime()) for s in fs.listStatus(p) if s.isFile()}
    return {n: t for n, t in found.items() if not n.startswith(("_", "."))}


def move_files(spark: SparkSession, folder: str, into: str, prefix: str) -> None:
    """Moves the data files of a folder into another one of the same store.
    ``prefix`` goes before their names: a job that writes several folders gives
    the same name to files in each."""
    fs, p = _fs(spark, folder)
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(s.getPath(), _fs(spark, f"{into}/{prefix}{name}")[1]):
            raise OSError(f"could not move {s.getPath()} to {into}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")
