"""A12 keyed upsert (merge-or-upload) on immutable Parquet directories.

Supplied fields overwrite, fields not supplied (null) keep the stored value,
new keys are inserted.  With ``order_col`` a stored row is only overwritten
by a newer (or equal) update, so late or replayed batches are harmless.

A table is dealt by a hash of its key into buckets, one folder each.  A merge
reads the buckets that its updates touch, and writes them alone, as folders of
the next version; a version's list of folders, written last by Spark's own
commit, says which folder each bucket has.  So files of other buckets stay as
they are, readers never see a version that is being written, and folders that
no kept version lists can be removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a table; fixed for its life, as keys stay in theirs.
BUCKETS = 64
#: Versions that stay readable behind the newest one.
KEPT_VERSIONS = 2
_BUCKET = "bucket_of_key_"


def keyed_upsert(base: DataFrame, updates: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Full outer join on the keys; per column ``coalesce(new, old)`` when the update applies."""
    value_cols = [c for c in base.columns if c not in keys]
    for c in updates.columns:
        if c not in keys and c not in value_cols:
            value_cols.append(c)
    b = base.select(*keys, *[F.col(c).alias(f"_old_{c}") if c in base.columns else
                             F.lit(None).alias(f"_old_{c}") for c in value_cols], F.lit(True).alias("_in_old"))
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") if c in updates.columns else
                                F.lit(None).alias(f"_new_{c}") for c in value_cols], F.lit(True).alias("_in_new"))
    j = b.join(u, keys, "full")
    applies = F.col("_in_new").isNotNull()
    if order_col is not None:
        applies = applies & (F.col(f"_old_{order_col}").isNull() |
                             (F.col(f"_new_{order_col}") >= F.col(f"_old_{order_col}")))
    out = [F.when(applies, F.coalesce(F.col(f"_new_{c}"), F.col(f"_old_{c}"))).otherwise(F.col(f"_old_{c}")).alias(c)
           for c in value_cols]
    return j.select(*keys, *out)


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path`` (local, HDFS, object stores alike)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the committed versions, oldest first."""
    fs, lists = _fs(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(lists):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(lists) if st.isDirectory()]
    return sorted(n for n in names if n.startswith("v=") and
                  fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/versions/{n}/_SUCCESS")))


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Name of the newest committed version, ``v=<number>-<source>-<batch>``, or None."""
    names = _versions(spark, root)
    return names[-1] if names else None


def _buckets(spark: SparkSession, root: str, version: str | None) -> dict[int, str]:
    """bucket -> folder (below the root) of a version; at most as many as the table has buckets."""
    if version is None:
        return {}
    rows = spark.read.schema("bucket int, folder string").parquet(f"{root.rstrip('/')}/versions/{version}").collect()
    return {r.bucket: r.folder for r in rows}


def _read(spark: SparkSession, root: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f}" for f in sorted(folders)])


def read_current(spark: SparkSession, root: str, schema) -> DataFrame:
    """The newest committed version."""
    return _read(spark, root, list(_buckets(spark, root, latest_version(spark, root)).values()), schema)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_into(spark: SparkSession, root: str, updates: DataFrame, keys: list[str], batch_id: int,
               order_col: str | None = None, source: str = "batch", buckets: int = BUCKETS,
               keep: int = KEPT_VERSIONS) -> str:
    """Merge ``updates`` into the table under ``root`` and publish the next version's name.

    The version follows the table's newest one, whatever the batch is called,
    so a stream that starts anew on an existing table goes on from it.  The
    name also tells the source and its batch: a batch that the newest version
    already holds isn't merged again.  Only touched buckets are read and
    written.  A failed attempt leaves folders that no version lists; the next
    attempt overwrites them.  Versions before the last ``keep`` are dropped
    with the folders that only they list.
    """
    names = _versions(spark, root)
    newest = names[-1] if names else None
    tag = f"{source}-{int(batch_id)}"
    number = 0
    if newest is not None:
        version, _, held = newest.removeprefix("v=").partition("-")
        if held == tag:
            return newest
        number = int(version) + 1
    listed = _buckets(spark, root, newest)
    own = bucket_of(keys, buckets)
    # a number for each touched bucket, as many as the table has at most
    touched = [r[0] for r in updates.select(own.alias("b")).distinct().collect()]
    old = _read(spark, root, [listed[b] for b in touched if b in listed], updates.schema)
    name = f"v={number:012d}-{tag}"
    merged = keyed_upsert(old, updates, keys, order_col).withColumn(_BUCKET, own)
    data = f"data/{name}"
    merged.repartition(max(1, len(touched)), _BUCKET).write.mode("overwrite").partitionBy(_BUCKET) \
        .parquet(f"{root.rstrip('/')}/{data}")
    listed |= {b: f"{data}/{_BUCKET}={b}" for b in touched}
    spark.createDataFrame(sorted(listed.items()), "bucket int, folder string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root.rstrip('/')}/versions/{name}")
    _expire(spark, root, [*names, name], keep)
    return name


def _expire(spark: SparkSession, root: str, names: list[str], keep: int) -> None:
    """Drop versions before the last ``keep`` and the folders that no other version lists."""
    gone, kept = names[:-1 - keep], names[-1 - keep:]
    if not gone:
        return
    used = {f for n in kept for f in _buckets(spark, root, n).values()}
    for n in gone:
        for folder in _buckets(spark, root, n).values():
            if folder not in used:
                fs, path = _fs(spark, f"{root.rstrip('/')}/{folder}")
                fs.delete(path, True)
        fs, path = _fs(spark, f"{root.rstrip('/')}/versions/{n}")
        fs.delete(path, True)
