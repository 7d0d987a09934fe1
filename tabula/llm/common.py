"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabula.session import ensure_checkpoint_dir

#: Broadcast a side only while its counted rows times ``row_bytes`` stay under this many bytes.
BROADCAST_BYTES = 64 << 20
#: Python tasks take this many documents at a time from an Arrow batch, to bound their memory.
SLICE_ROWS = 256


#: Bytes of one Arrow batch between Spark and its Python workers.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch to ``BATCH_BYTES``. The default of 64 MB is held
    several times over by every running task, on either side, and texts fill it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(name).lower())
    if now is None or int(now[1]) << 10 * " kmgt".index(now[2] or " ") > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def workspace(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir`` for one run's tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; other columns never clash."""
    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def small_side(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def small_table(df: DataFrame, bytes_: Column, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``small_side`` for rows of very different sizes: ``bytes_`` is the size of a row."""
    return F.broadcast(df) if (df.agg(F.sum(bytes_)).first()[0] or 0) <= max_bytes else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, rejected: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` but those whose ``keys`` (column of ``rejected`` -> expression over ``docs``) are all
    equal to those of a row of ``rejected``. A null key equals nothing, so such rows stay."""
    names = {k: f"_rejected_{i}" for i, k in enumerate(keys)}
    gone = rejected.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    # written before it is counted and joined, so that what rejects runs once
    gone = small_side(saved(gone, workspace(docs.sparkSession, "rejected")), 64 * len(keys))
    same = [expression == gone[names[k]] for k, expression in keys.items()]
    return docs.join(gone, same, "left_anti")


def ascii_lower(text: Column | str) -> Column:
    """A-Z to a-z, every other character as it is. ``lower`` does that to ASCII texts at a fraction of the cost."""
    letters = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(letters)


def slices(batch, size: int = SLICE_ROWS):
    """An Arrow batch in parts of ``size`` rows."""
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def releasing(run, forget=None):
    """The mapper ``run``, giving back what its task remembered when it ends, to the system as well: Python workers
    wait for the tasks of later stages, which would otherwise inherit it."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow

            if forget:
                forget()
            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library keeps freed memory unless told
            if trim:
                trim(0)

    return task


def sample_per_label(rows: DataFrame, count: int) -> DataFrame:
    """Of (id, label): per label the ``count`` rows of the smallest id hash.

    The labels are counted first, and rows whose hash is far beyond what the count needs are left
    out before the ranking, so that it moves a few rows per label however many tasks there are.
    """
    top = (1 << 63) - 1
    hashed = rows.select("id", "label", F.xxhash64("id").bitwiseAND(F.lit(top)).alias("_h"))
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    enough = F.when(F.col("_n") <= 4 * count, F.lit(top)).otherwise((F.lit(4.0 * count) / F.col("_n") * F.lit(float(top))).cast("long"))
    near = hashed.join(small_side(sizes, 64), "label").where(F.col("_h") <= enough)
    order = Window.partitionBy("label").orderBy("_h", "id")
    return near.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= count).select("id", "label")
