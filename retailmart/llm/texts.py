"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.sources.files import scratch_path

#: Text bytes that a task works on at once. One longer text is a slice of its own.
SLICE_BYTES = 4_000_000
#: Equal rows that one task writes out again at once.
COPIES = 100_000


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows so that a slice holds about ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column, nulls as empty; text i is bytes[offsets[i]:offsets[i + 1]]."""
    kind = pa.binary() if pa.types.is_binary(column.type) else pa.string()
    column = pc.fill_null(column, pa.scalar(b"" if kind == pa.binary() else "", kind))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8 bytes, null as empty."""
    data, offsets = buffer_of(column)
    whole = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield whole[a:b]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: two running minima over blocks of that width."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def map_arrow(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = SLICE_BYTES
) -> DataFrame:
    """Apply ``work`` to slices of about ``limit`` bytes of text; the frame needs a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit=limit):
                out = work(piece)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later work does not repeat it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A checkpoint in the session's shared folder; sets a folder only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names, so that other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def numbered_copies(rows: DataFrame, part: int = COPIES) -> DataFrame:
    """The rows with ``_copy``, a number from 1 among equal rows. Equal rows are counted before the shuffle, and the
    number depends on nothing but the rows, so a task that runs again gives the same. A row found more than ``part``
    times is written out again in parts, which are dealt to all tasks."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_times"))
    few = counted.where(F.col("_times") <= part).select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), "_times")).alias("_copy"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_times - 1) div {part}"))).alias("_part")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = counted.where(F.col("_times") > part).select(*rows.columns, "_times", parts).repartition(tasks, "_part")
    first, last = F.col("_part") * part + 1, F.least((F.col("_part") + 1) * part, F.col("_times"))
    return few.unionByName(many.select(*rows.columns, F.explode(F.sequence(first, last)).alias("_copy")))
