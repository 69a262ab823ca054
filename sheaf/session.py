"""Session helpers: a local session for tests and the bench, and the shared
scratch location every job writes intermediate tables to.

On a cluster the session already exists and names ``spark.checkpoint.dir``
(a shared folder every executor can reach). Jobs read that setting; only a
local session made here for tests sets one of its own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sheaf") -> SparkSession:
    """A local session configured like the cluster one: UTC, ANSI, AQE with
    skew-join and coalescing, UI off, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SHEAF_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.schemaInference", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when
    the session names none (local tests)."""
    sc = _context(spark)
    current = spark.conf.get(_CHECKPOINT_KEY, None) or (sc.getCheckpointDir() if sc is not None else None)
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if sc is not None and not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", sc.master):
        raise RuntimeError(f"{_CHECKPOINT_KEY} must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sheaf-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def session_id(spark: SparkSession) -> str:
    """Identity of the running application (for per-session caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for one run of one
    job: stream checkpoints, landing folders, change logs."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/sheaf/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a folder, through the session's Hadoop settings."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder (empty if it is not there)."""
    fs, target = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def pending_path(spark: SparkSession, path: str) -> str:
    """Where the folder ``path`` is made ready: beside it, under a name that
    readers ignore. What an earlier attempt left there goes."""
    target = _hadoop(spark, path)[1]
    fs, pending = _hadoop(spark, f"{target.getParent().toString()}/_pending/{target.getName()}")
    fs.delete(pending, True)
    return pending.toString()


def publish_folder(spark: SparkSession, pending: str, path: str) -> None:
    """Give the finished folder its name: one rename, so readers see all of
    it or nothing."""
    fs, target = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    if not fs.rename(_hadoop(spark, pending)[1], target):
        raise OSError(f"cannot rename {pending} to {path}")


def publish(df: DataFrame, path: str) -> bool:
    """Write ``df`` as the parquet folder ``path``, whole and once: the files
    are written under a name that readers ignore and the folder is renamed
    when complete. A folder already there is kept as it is (a replayed batch
    holds the same rows, and a reader that has seen its files must not see
    them again under other names). Returns whether anything was written."""
    spark = df.sparkSession
    if path_exists(spark, path):
        return False
    pending = pending_path(spark, path)
    df.write.parquet(pending)
    publish_folder(spark, pending, path)
    return True


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Tie the table at ``path`` to the stream of ``checkpoint``. Batch
    numbers belong to a checkpoint, so another one (or a checkpoint that was
    deleted and made anew) would number its rows like batches that are already
    there; that raises in place of skipping them."""
    import json

    fs, target = _hadoop(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = fs.open(target)
    try:
        name = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()
    known = folder_names(spark, f"{path.rstrip('/')}/_stream")
    if known and known != [name]:
        raise RuntimeError(f"{path} is fed by stream {known[0]}; {checkpoint} is another stream ({name}): use its checkpoint, or a new table")
    if not known:
        if any(n.startswith("batch_id=") for sub in ("log", "batches") for n in folder_names(spark, f"{path.rstrip('/')}/{sub}")):
            raise RuntimeError(f"{path} holds batches of no known stream; {checkpoint} cannot go on from them: use a new table")
        fs.mkdirs(_hadoop(spark, f"{path.rstrip('/')}/_stream/{name}")[1])


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage
    (never a local checkpoint: an executor loss must not lose the data)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


class session_settings:
    """Context manager: the given session settings hold inside it; the
    session's own values are restored after."""

    def __init__(self, spark: SparkSession, settings: dict[str, str] | None):
        self.spark = spark
        self.settings = dict(settings or {})
        self._old: dict[str, str | None] = {}

    def __enter__(self):
        for k, v in self.settings.items():
            self._old[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, str(v))
        return self

    def __exit__(self, *exc):
        for k, v in self._old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


class variant_shredding(session_settings):
    """VARIANT columns written inside it are shredded (the common paths
    become typed parquet columns), so later path reads that Spark pushes
    into the scan can use those columns instead of the whole value. Not
    ``enabled`` (``None`` keeps the session's settings), they are written
    whole, also where the session shreds."""

    def __init__(self, spark: SparkSession, enabled: bool | None = True):
        super().__init__(spark, None if enabled is None else dict.fromkeys(_SHREDDING, str(bool(enabled)).lower()))
