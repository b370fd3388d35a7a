"""Building blocks that keep large jobs spread over the cluster.

``settle``          write an intermediate table once and read it back
``settle_last``     the same, and drop the shuffle files behind it
``settle_by``       the same, written as it is dealt by a key
``discard``         delete settled tables that nothing reads any more
``release``         delete all of them at the end of a job
``match``           equi-join that keeps rows with null keys
``running_totals``  cumulative sums over a total order, without one big sort task
``seeded_hash``     repeatable pseudo-random order of ids
``seeded_cuts``     the id at a wanted rank of that order, per stratum
``seeded_rank``     the rank itself

The seeded operators expect a unique id; rows that share one stay together.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOCAL: dict[str, str] = {}  # folders of local sessions for which none is set
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BUCKET_DIGITS = 4  # hex digits of the hash that name a bucket: 65,536 buckets


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors reach, as named by the cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="run-")
        LOCAL[spark.sparkContext.applicationId] = folder
    return folder


def run_folder(spark: SparkSession) -> str:
    """Folder of this application inside the shared one; all intermediate tables are below it."""
    return f"{shared_folder(spark).rstrip('/')}/textgrove-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path for a table or stream in the folder of this application."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application.

    For the end of a job, when its results are written elsewhere: tables that
    operators returned may still be read from there.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and return it as read from there.

    The lineage ends at files that outlive any executor, and the planner knows
    the true size: it broadcasts the table in later joins if, and only if, that
    size is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return _placed(spark.read.schema(df.schema).parquet(path), path)


def settle_last(df: DataFrame, name: str = "settled") -> DataFrame:
    """``settle`` for a plan that is run this once: the files of its shuffles go as soon as it is written.

    Else they stay on the disks of the executors until the driver happens to collect its garbage.
    """
    with shuffles_dropped(df.sparkSession):
        return settle(df, name)


def settle_by(df: DataFrame, key: str, name: str = "settled", **options: str) -> DataFrame:
    """``settle_last`` for a table that is dealt by ``key`` to the session's number of shuffle partitions.

    It keeps that layout, so joins on ``key`` find the rows of a key in one task without a shuffle.
    ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    table, path = f"settled_{uuid.uuid4().hex}", new_path(spark, name)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_dropped(spark):
        df.write.bucketBy(parts, key).sortBy(key).options(path=path, **options).format("parquet").saveAsTable(table)
    try:
        return _placed(spark.table(table), path)
    finally:
        spark.sql(f"DROP TABLE {table}")  # its name; the files stay


def _placed(df: DataFrame, path: str) -> DataFrame:
    df._settled_at = path
    return df


def discard(*settled: DataFrame) -> None:
    """Delete settled tables as soon as nothing reads them any more, before the end of the job."""
    for df in settled:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, the files of the shuffles of a plan go as soon as it has run."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of an input that sits in a handful of small files.

    A table of at least as many splits as cores is returned as it is, without a
    shuffle. Meant for tables just read: asking a longer plan for its partitions runs it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def match(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal or equally null keys; the keys of ``left`` are kept."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def running_totals(
    df: DataFrame, order: list[str], values: list[str], by: list[str] | None = None
) -> DataFrame:
    """Add ``<value>_before``, the sum over all earlier rows, and ``<value>_total``.

    ``order`` must be unique within ``by``. The rows are range-partitioned and
    written once, so that both later passes see the same ranges; each range is
    summed for itself and shifted by the total of the ranges before it. There
    are as many ranges as shuffle partitions, so the offsets stay small.
    """
    by = by or []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(
        df.repartitionByRange(parts, *by, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*by, "_range").agg(*[F.sum(v).alias(v) for v in values])
    offsets = sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_{v}_offset") for v in values],
        *[F.sum(v).over(Window.partitionBy(*by)).alias(f"{v}_total") for v in values],
    )
    inside = (
        Window.partitionBy("_range", *by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifted = match(ranged, settle(offsets, "offsets"), ["_range", *by])
    before = lambda v: F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_{v}_offset")
    return shifted.select(
        *df.columns,
        *[before(v).alias(f"{v}_before") for v in values],
        *[f"{v}_total" for v in values],
    )


def seeded_hash(id_col: str, seed: int | str = 42) -> Column:
    """Hash of seed and id; sorting by it shuffles the rows repeatably."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def _keyed(df: DataFrame, id_col: str, seed: int | str, by: list[str]) -> DataFrame:
    hashed = df.select(*by, F.col(id_col).alias("_id"), seeded_hash(id_col, seed).alias("_hash"))
    return hashed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))


def seeded_cuts(
    df: DataFrame,
    wanted: DataFrame,
    names: list[str],
    id_col: str,
    by: list[str],
    seed: int | str = 42,
) -> DataFrame:
    """Where to cut the shuffled rows of each stratum to get given counts.

    ``wanted`` holds ``(by..., cut, k)``, ``names`` lists the cuts. The result has one row per stratum
    and a column per cut name, ``struct(_hash, _id)`` of its k-th row: a row is
    among the first k when its own struct is not greater. Only ids and strata
    are read, the counts of the hash buckets are shuffled, and only the rows of
    the buckets that hold a k-th row are sorted.
    """
    keyed = _keyed(df, id_col, seed, by)
    upto = Window.partitionBy(*by).orderBy("_bucket")
    buckets = (
        keyed.groupBy(*by, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
    )
    hit = settle(
        match(buckets, wanted, by)
        .filter((F.col("k") > F.col("_upto") - F.col("_n")) & (F.col("k") <= F.col("_upto")))
        .select(*by, "_bucket", "cut", (F.col("k") - F.col("_upto") + F.col("_n")).alias("_nth")),
        "buckets",
    )
    ranked = match(keyed, hit.select(*by, "_bucket").distinct(), [*by, "_bucket"]).withColumn(
        "_row", F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_hash", "_id"))
    )
    found = match(ranked, hit, [*by, "_bucket"]).filter(F.col("_row") == F.col("_nth"))
    cuts = found.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("cut") == n, F.struct("_hash", "_id"))).alias(n)
            for n in names
        ]
    )
    return settle(cuts, "cuts")


def within(id_col: str, seed: int | str, cut: str) -> Column:
    """True for rows up to a cut of ``seeded_cuts``; false where the cut takes none."""
    key = F.struct(seeded_hash(id_col, seed).alias("_hash"), F.col(id_col).alias("_id"))
    return F.coalesce(key <= F.col(cut), F.lit(False))


def seeded_rank(
    df: DataFrame, id_col: str, seed: int | str = 42, by: list[str] | None = None, name: str = "rank"
) -> DataFrame:
    """Add the 1-based position of each row in the shuffled order of its stratum.

    Hash buckets are ranked in parallel; the counts of the buckets, one small
    table, give offsets. The rows are shuffled once, by bucket.
    """
    by = by or []
    hashed = df.withColumn("_hash", seeded_hash(id_col, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        _keyed(df, id_col, seed, by)
        .groupBy(*by, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = Window.partitionBy(*by, "_bucket").orderBy("_hash", id_col)
    return (
        match(hashed, settle(offsets, "offsets"), [*by, "_bucket"])
        .withColumn(name, F.col("_offset") + F.row_number().over(local))
        .drop("_hash", "_bucket", "_offset")
    )
