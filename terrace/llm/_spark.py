"""What the operators share: the scratch folder of the cluster, written tables, and slices of Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one call into a vectorised step works on.
SLICE_BYTES = 4_000_000
#: Bytes of a batch that Spark sends to a Python worker. A longer row is a batch alone.
BATCH_BYTES = 4_000_000
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Gives Arrow batches of this session BATCH_BYTES, unless it has a limit of its own; read when a job starts.

    Spark's default of 64 MB takes several times as much of an executor outside its heap, for each task: vectors double as
    they fill, the batch is sent as a copy, and the worker holds it whole beside what it returns.
    """
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder; on a cluster executors wouldn't see it, so that is an
    error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="terrace-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system; both are Hadoop's, as only that reaches every store that Spark writes to."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def run_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one. It goes when the application ends, as results may be read until then."""
    path = f"{shared_dir(spark)}/terrace-{spark.sparkContext.applicationId}"
    if path not in _RUNS:
        _RUNS.add(path)
        folder, fs = _hadoop_path(spark, path)
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return path


_RUNS: set[str] = set()
_SCOPES: list[str] = []


@contextlib.contextmanager
def scope(spark: SparkSession):
    """What is written inside goes at the end; for steps whose result is written before that."""
    path = f"{run_dir(spark)}/step-{uuid.uuid4().hex}"
    _SCOPES.append(path)
    try:
        yield
    finally:
        _SCOPES.remove(path)
        folder, fs = _hadoop_path(spark, path)
        fs.delete(folder, True)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{_SCOPES[-1] if _SCOPES else run_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors, and gives the planner a size."""
    bounded_batches(df.sparkSession)
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def release() -> None:
    """Gives what is free in this worker back to the system. Workers outlive tasks and stages, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about size bytes of a text column; one longer text is a batch alone.

    After each batch that comes, what is free then goes back to the system.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(at, to - at)
            at = to
        release()


def row_key(*columns: str) -> F.Column:
    """128 bits that stand for the values of some columns; 64 are too few for the rows of a large corpus."""
    return F.unhex(F.md5(F.concat_ws("\x1f", *(F.col(c).cast("string") for c in columns))))


def spread(flat: np.ndarray, sizes: np.ndarray, use: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts from those of their distinct words.

    flat: the ids of every distinct word in turn, sizes of them each. use: which word stands at each place. bounds: the
    places at which each text begins, and the last one ends. Returns all ids in turn, and where each text's begin.
    """
    begins = np.cumsum(sizes) - sizes
    lengths = sizes[use]
    ends = np.cumsum(lengths)
    ids = flat[np.repeat(begins[use] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
    return ids, np.concatenate([[0], ends])[bounds - bounds[0]].astype(np.int64)


def runs(words: list[str], size: int = 2000) -> list[list[str]]:
    return [words[i : i + size] for i in range(0, len(words), size)]


#: Bytes of the files of a table that is sent to every executor.
BROADCAST_BYTES = 8_000_000
#: Bytes of its rows in memory by the planner's widths of types, as files of repeated values hold far more than their size.
BROADCAST_MEMORY = 32_000_000


def file_bytes(side: DataFrame) -> int:
    """Bytes of the folders that a written table is read from; no job runs for it."""
    spark = side.sparkSession
    folders = {f.rpartition("/")[0] for f in side.inputFiles()}
    return sum(fs.getContentSummary(path).getLength() for path, fs in (_hadoop_path(spark, f) for f in folders))


def small(side: DataFrame) -> bool:
    """Whether a written table may be sent to every executor; rows are counted in the footers of its files."""
    return file_bytes(side) <= BROADCAST_BYTES and side.count() * (side._jdf.schema().defaultSize() + 16) <= BROADCAST_MEMORY


def sized_join(rows: DataFrame, side: DataFrame, on: list[str] | str, how: str) -> DataFrame:
    """A join with a written table: broadcast while it is small, else both sides are shuffled.

    As side is a table of its own, rows aren't dealt for an aggregation by the same key, and Spark may split hot keys.
    """
    return rows.join(F.broadcast(side) if small(side) else side, on, how)


def id_filter(rows: DataFrame, ids: DataFrame, key: list[str] | str, how: str) -> DataFrame:
    """rows with (left_semi) or without (left_anti) the keys in ids, a written table."""
    return sized_join(rows, ids, key, how)
