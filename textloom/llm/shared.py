"""What the corpus operators share: the shared folder, tables written to it, and joins that
broadcast only what has been measured to be small."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only if it was counted and has at most this many bytes.
BROADCAST_BYTES = 16 << 20
#: Rows of an Arrow batch of texts: it is in memory as a whole, on both sides, and texts may be long.
BATCH_ROWS = 1_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local master may go without
    ``spark.checkpoint.dir``; it then gets a temporary folder."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="textloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/textloom/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """The table, written to the shared folder and read again: its lineage ends there. ``by``:
    columns of few values, each of which gets folders of its own."""
    spark = df.sparkSession
    path = path or scratch(spark, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Intermediate tables of one operator's run, deleted together when they have had their last use."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.made = spark, scratch(spark, name), 0

    def written(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        self.made += 1
        return written(df, name, f"{self.root}/{self.made:03d}-{name}", by)

    def close(self) -> None:
        """Call it when everything that reads these tables has been written elsewhere."""
        remove(self.spark, self.root)


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def worker_uri(spark: SparkSession, path: str) -> str:
    """``path`` as Hadoop qualifies it, in a form that pyarrow reads on the workers. A path without
    scheme belongs to the default file system, which need not be the local one."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(target).toString()
    scheme, _, rest = uri.partition(":")
    uri = "file://" + rest if scheme == "file" and not rest.startswith("//") else uri
    uri = "s3" + uri[3:] if scheme in ("s3a", "s3n") else uri
    try:
        pafs.FileSystem.from_uri(uri)
    except (ValueError, NotImplementedError, pa.ArrowException) as e:
        raise ValueError(f"workers cannot write files below {uri}: spark.checkpoint.dir must be in a store that pyarrow knows") from e
    return uri


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df``, marked for broadcasting if its counted rows fit; otherwise joins shuffle it."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is not in ``dropped`` (a written table with that one column)."""
    gone = fresh(docs, "__gone")
    side = dropped.select(F.col(key).alias(gone)).distinct()
    return docs.join(small(side, dropped.count(), 64), docs[key].eqNullSafe(F.col(gone)), "left_anti")


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary") if isinstance(key, str) else key) % modulus


def ensure_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function on batches that gives the memory it has freed back to the system when the
    task ends: Python workers live on, and what they hold counts against their executor. Batches of
    texts get BATCH_ROWS rows at most, unless the session says otherwise."""
    session, key = SparkSession.getActiveSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if session is not None and session.conf.get(key, None) is None:
        session.conf.set(key, str(BATCH_ROWS))

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return tidied
