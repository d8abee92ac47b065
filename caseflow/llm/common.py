"""Small helpers shared by the operators: words, training splits, shared files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.session import ensure_checkpoint_dir

#: Characters between words: space and the five ASCII control blanks.
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a batch that goes to Python.
BATCH_ROWS = 1000


def words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text; none for null."""
    return text.split() if text else []


def crc_mod(doc_id: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and odd multiplications), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small_batches(spark: SparkSession) -> None:
    """Have this session pass rows to Python a thousand at a time, unless it asks for fewer.

    The default of ten thousand makes a batch of whole texts some tens of MB,
    held in the JVM and in each Python worker at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "0")) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, to bound what a task makes of one batch."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def run_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the shared checkpoint folder that the session names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: later jobs, and tasks rerun after an executor is lost,
    read the files instead of computing the plan again.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark, kind)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_range(uri: str, start: int = 0, length: int | None = None) -> bytes:
    """Bytes of a file from ``start``; all that follow where ``length`` is None."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(path) as src:
        src.seek(start)
        return src.read() if length is None else src.read(length)


def remove_folder(uri: str) -> None:
    """Delete a folder of this run, once nothing reads it any more."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.delete_dir(path)


#: Groups that ``join_hot`` broadcasts, at most.
HOT_GROUPS = 1000


def join_hot(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group; null is a key like others.

    ``groups`` has one row for each key, with the number of its rows in
    ``size``; ``total`` is the sum of these numbers.  Groups of more than
    ``total / HOT_GROUPS`` rows, which are less than ``HOT_GROUPS``, are
    broadcast, so no key with more rows than that goes to one task.
    """
    named = groups.withColumnRenamed(key, "key_of_group_")
    hot = F.col(size) > max(1, total // HOT_GROUPS)
    same = F.col(key).eqNullSafe(F.col("key_of_group_"))
    few = F.broadcast(named.where(hot))
    often = rows.join(few, same)
    seldom = rows.join(F.broadcast(named.where(hot).select("key_of_group_")), same, "left_anti") \
        .join(named.where(~hot), same)
    return often.unionByName(seldom).drop("key_of_group_")
