"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python works on about so many bytes of text at once, whatever the size of an Arrow batch.
CHUNK_CHARS = 1_000_000
#: Rows of an Arrow batch of texts, at most; Spark's own bound of 10,000 rows is for short ones.
BATCH_ROWS = 1_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id, as text, leaves no remainder by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def row_key(id_col: str, text_col: str) -> Column:
    """What decisions are joined on: the id, or the text's hash where the id is null (a struct's null fields are equal in a join)."""
    nameless = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col).cast("string")))
    return F.struct(F.col(id_col).alias("id"), nameless.alias("text_key"))


def text_key(id_col: str, text_col: str) -> Column:
    """What decisions on single rows are joined on: rows with equal keys have the same id and text."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text"))


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores more as make it none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session; where none is set, a folder of our own in local mode, as in tests, and an error on a cluster."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if shared is None:
            if not sc.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            shared = tempfile.mkdtemp(prefix="kinweave-checkpoints-")
        sc.setCheckpointDir(shared)
    return shared or sc._jsc.sc().getCheckpointDir().get()


def text_batches(df: DataFrame) -> DataFrame:
    """df, with its session's Arrow batches bounded for long texts: both sides of a Python worker's socket hold a batch."""
    conf = df.sparkSession.conf
    most = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < most <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def released(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts; at their end, what a task has freed goes back to the system, since its worker is kept for later stages."""
    yield from parts
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_slices(column: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str | None]]]:
    """(start, end, texts) of runs of rows with about ``limit`` bytes; a longer text stands alone. Only one run is held as Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start, held = 0, 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(ends, held + limit, side="right")))
        yield start, end, column.slice(start, end - start).to_pylist()
        start, held = end, ends[end - 1]


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a Parquet table in the shared folder.

    Unlike a checkpoint it is compressed and forgets the partitioning, so that a later join deals both
    of its sides anew and adaptive execution can split a hot key.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/kinweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes stored tables; only for those of which every result that is still to be read has itself been stored."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def semi_by_id(df: DataFrame, ids: DataFrame, n: int, on: str, how: str = "left_semi", limit: int = 2_000_000) -> DataFrame:
    """Rows of df with (or, left_anti, without) an id of ids; n is the counted size of ids, and only a checked size is broadcast."""
    return df.join(F.broadcast(ids) if n <= limit else ids, on, how)
