"""Session-level helpers: tables, lineage cuts, joins that survive hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot when it holds more rows than this, which one task takes easily, or a 2000th of all
#: rows if that is more; so there are never more than 2000 hot keys and their list may be broadcast.
HOT_ROWS = 200_000
HOT_KEYS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table of that name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Where it is unset, a temporary folder serves local sessions only; on a cluster it would be
    one machine's, so there it is an error.
    """
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {key} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="loomleaf-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame, **counts: Column) -> DataFrame:
    """The same rows with their lineage cut by a table written to the shared folder.

    A written table rather than checkpoint(): a checkpointed plan carries its constraints and
    partitionings along, which double in every round of a loop that joins it to itself.
    Executors may be lost afterwards. release() removes the files once nothing reads them.
    counts are aggregates that are taken while the table is written; counted() gives them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomleaf-cut-{uuid.uuid4().hex}"
    seen = Observation() if counts else None
    (df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items()]) if seen else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._loomleaf_path = path
    out._loomleaf_counts = seen.get if seen else {}
    return out


def counted(df: DataFrame, name: str) -> int:
    """What was counted under that name while cut() wrote the table."""
    return int(df._loomleaf_counts[name])


def release(*cuts: DataFrame) -> None:
    """Remove the files behind what cut() gave."""
    for df in cuts:
        jvm, path = df.sparkSession._jvm, df._loomleaf_path
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def hot_limit(rows: int) -> int:
    """From how many rows a key counts as hot, when there are so many rows in all."""
    return max(HOT_ROWS, rows // HOT_KEYS)


def stripped(c: Column | str) -> Column:
    """Without surrounding white space of any script (trim alone removes U+0020 only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def hot_keys(counts: DataFrame, key: str, n: str, rows: int) -> DataFrame | None:
    """The hot keys among counts (a row per key), never more than HOT_KEYS; None if there are none. rows: of the table that is counted."""
    if rows <= HOT_ROWS:
        return None
    found = counts.where((F.col(n) > hot_limit(rows)) & F.col(key).isNotNull()).select(key).limit(HOT_KEYS).collect()
    return counts.sparkSession.createDataFrame(found, counts.select(key).schema) if found else None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    hot: DataFrame | None,
    spread: str,
    salts: int = 32,
    how: str = "left",
) -> DataFrame:
    """left joined with right, whose key on[1] is unique, by sort-merge, hot keys salted.

    hot has one column, the hot values of on[0], as hot_keys gives them; it is broadcast. Rows
    of left with a hot key are spread over `salts` parts by the hash of column `spread`, and the
    one row of right is repeated for each part. Columns of right must not clash with those of
    left. Null keys join nothing.
    """
    lk, rk = on
    if hot is None:
        # The optimizer broadcasts right only where its measured size is under the session's threshold.
        return left.join(right, F.col(lk) == F.col(rk), how)
    marked = F.broadcast(hot.select(F.col(hot.columns[0]).alias("_hot")))
    part = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    # A null key would send all its rows to one task; such rows get a scattered salt too.
    a = left.join(marked, F.col(lk) == F.col("_hot"), "left").withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(lk).isNull(), part).otherwise(F.lit(0)))
    b = right.join(marked, F.col(rk) == F.col("_hot"), "left").withColumn(
        "_part", F.explode(F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    b = b.drop("_hot").hint("merge")
    return a.drop("_hot").join(b, (F.col(lk) == F.col(rk)) & (F.col("_salt") == F.col("_part")), how).drop("_salt", "_part")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def least_parts(spark: SparkSession) -> int:
    """Twice as many parts as there are cores: what a costly stage should have at least."""
    return 2 * spark.sparkContext.defaultParallelism


def spread(df: DataFrame) -> DataFrame:
    """A scan in at least so many parts that all cores are busy; moved only where its files give fewer.

    For costly Python stages over small or few files; inputs that already fill the cluster aren't
    shuffled. df must not hold a shuffle itself, which would run to tell its parts.
    """
    least = least_parts(df.sparkSession)
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def distinct_by(df: DataFrame, key: str) -> DataFrame:
    """The distinct rows, kept in enough parts for a costly stage to follow; one shuffle, by the key alone."""
    n = max(least_parts(df.sparkSession), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key).distinct()


def running_total(df: DataFrame, group: str, key: str, value: str, name: str, rows: int, per_bucket: int = 50_000) -> DataFrame:
    """df with `name`: the sum of `value` over the rows before it in its group, in a seeded order of `key`.

    Rows are ordered by a bucket of the key's hash and then by key, so that no window runs over
    a whole group: within a bucket first, then over the sums of a group's buckets. rows is the
    number of all rows; a null group is a group. Keys must be unique within a group.
    """
    buckets = max(8, -(-rows // per_bucket))
    t = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    sums = t.groupBy(group, "_bucket").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(group, "_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    t = t.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return t.withColumn(name, F.col("_start") + F.col("_inside")).drop("_bucket", "_group", "_b", "_start", "_inside")
