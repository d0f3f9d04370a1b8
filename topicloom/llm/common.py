"""What the operators of this subpackage share: sessions, shared storage, table reading, bounded caches."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: bounds a Python worker's memory whatever the length of the texts.
ARROW_ROWS, ARROW_BYTES = 512, 8 << 20
#: Rows of one key that a join may gather in a task; rows that may be broadcast; parts of a key beyond them.
HOT_ROWS, BROADCAST_ROWS, SALTS = 20_000, 20_000, 16
#: Short rows that are worth a task of their own.
TASK_ROWS = 20_000


def session(spark: SparkSession) -> SparkSession:
    """Settings that the operators rely on; workers find this package where the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, where that is unset the warehouse's, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder: what follows survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder as Parquet and read again: as cut(), without the constraints that a checkpoint's plan inherits and that a driver plans with ever after."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fenced(df: DataFrame, computed: list[str]) -> DataFrame:
    """df with the computed columns behind a generator: what later filters on them isn't pushed below, where their expressions would be evaluated again."""
    return df.select(*[c for c in df.columns if c not in computed], F.inline(F.array(F.struct(*computed))))


def ranked(df: DataFrame, by: list[str], order: list[str], out: str) -> DataFrame:
    """out: the row's 1-based place among rows of equal by[:-1], by (bucket by[-1], order): only a bucket's rows are sorted together. No null in by."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_r", within).join(offsets, by).withColumn(out, F.col("_r") + F.col("_before")).drop("_r", "_before")


def told_apart(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """out: the row's number among those equal in these columns, from 1. df is kept in the shared folder, so that its partitions stay; a value's rows are counted by partition and never gather."""
    rows = df.withColumn("_key", F.xxhash64(*columns)).withColumn("_part", F.spark_partition_id())
    return ranked(rows, ["_key", "_part"], ["_key"], out).drop("_key", "_part")


def spread(df: DataFrame) -> DataFrame:
    """df dealt out evenly over as many tasks as shuffles have: for rows that are about to multiply."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def gathered(df: DataFrame, rows: int, at_once: int = TASK_ROWS) -> DataFrame:
    """df, which has so many rows at most, in no more tasks than these need: each shuffle and each table kept in the shared folder costs files for each task, however little they hold."""
    return df.coalesce(max(1, -(-rows // at_once)))


def beside_hot(rows: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with `one`, which holds a key once. Keys of over HOT_ROWS of the rows are taken out by broadcast (of these there are few; if not, they are dealt out over salts), so that none gathers in a task."""
    if rows.limit(HOT_ROWS + 1).count() <= HOT_ROWS:  # so few rows have no such key
        return rows.join(one, key, how)
    hot = cut(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(key))
    if hot.isEmpty():
        return rows.join(one, key, how)
    apart = one.join(hot, key, "left_semi")
    if hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hot, busy = F.broadcast(hot), rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(apart), key, how)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
        busy = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).join(hot.select(key, salts), [key, "_salt"], "left_semi").join(apart.select("*", salts), [key, "_salt"], how).drop("_salt")
    return rows.join(hot, key, "left_anti").join(one, key, how).unionByName(busy)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_column(df: DataFrame, name: str = "text") -> F.Column:
    """The text, null as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


#: Words beyond it are seldom seen again and would make a cache of a bounded number of entries as large as they like.
LONGEST_KEY = 256


class Generations(dict):
    """A cache bounded to two generations of `size` entries of at most LONGEST_KEY characters or bytes; `make` computes what is missing."""

    def __init__(self, make, size: int = 400_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        self.put_all([(key, value)])

    def put_all(self, pairs) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self.update((key, value) for key, value in dict(pairs).items() if len(key) <= LONGEST_KEY)


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """A public vocabulary file: in `folder`, or where the package public_tokenizers keeps it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))
