"""What the operators share: tables between steps, words, and offsets in a distributed order."""

from __future__ import annotations

from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from oreflow.scratch import scratch_folder

# Fixed value: A-Z and what they become.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
# Fixed value: white space that ends a word (space, and 9 to 13).
SPACE_CLASS = r"[\x20\x09-\x0D]"


class Workspace:
    """Tables that a query writes between its steps, in the folder that all executors share.

    A written table cuts the lineage: a lost executor costs the step that runs, not the whole
    query.  ``drop`` deletes tables that nothing reads any more; the rest goes when the process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_folder(spark, name)
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table of its own; ``df.kept_at`` says where."""
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.kept_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(table.kept_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of words."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` spread over the whole word (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each window of ``k`` words; with fewer words, one for all of them."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * _STEP + words[i : n - size + 1 + i])
    return out


def running_offsets(
    rows: DataFrame, amount: str, stream: list[str], order: list[Column], out: str = "start"
) -> DataFrame:
    """Adds the sum of ``amount`` over the earlier rows of the same stream.

    The rows carry ``bucket``, a long that never falls along ``order``.  A bucket is summed by itself
    and the sums of the buckets are added up; with about as many buckets as rows in each
    (``buckets_for``) no task holds a stream, however large.
    """
    keys = [*stream, "bucket"]
    sums = rows.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*stream).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return marked.join(bases, same).select(
        *rows.columns, (F.col("_in") + F.col("_base")).cast("long").alias(out)
    )


def salted_lookup(
    rows: DataFrame, facts: DataFrame, key: str, how: str = "inner", total: int | None = None, parts: int = 1024
) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has a row for each value of ``key`` and its number ``n`` of rows.

    A value with more than a ``parts``-th of all rows is divided: its rows are dealt over as many salts as
    it has such parts, and its one fact is copied to each.  There are fewer than ``parts`` such values, so
    their list is small at any size; rows without a value, which meet nothing, are dealt over
    ``parts`` salts.  ``rows`` should be a stored table, whose rows are numbered alike if a task runs again.
    """
    if total is None:
        total = facts.agg(F.sum("n")).first()[0] or 0
    part = max(total // parts, 1)
    hot = facts.where(F.col("n") > part).select(F.col(key).alias("_hot"), F.ceil(F.col("n") / part).alias("_salts"))
    salts = F.coalesce("_salts", F.when(F.col(key).isNull(), parts).otherwise(1))
    few = F.broadcast(hot)
    dealt = rows.join(few, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), salts)
    )
    copied = facts.join(few, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))
    )
    copied = copied.drop("_hot", "_salts", "n")
    # Without a hint, so that adaptive execution may still send a small table of facts to all.
    return dealt.drop("_hot", "_salts").join(copied, [key, "_salt"], how).drop("_salt")


def buckets_for(n_rows: int) -> int:
    """About the square root of ``n_rows``, as a power of two: buckets and rows in each stay alike."""
    return 1 << max(0, (max(n_rows, 1).bit_length() + 1) // 2)


def hash_bucket(n_buckets: int, *cols: Column) -> Column:
    """A bucket by the high bits of a 64-bit hash, so that buckets and hashes have one order."""
    bits = n_buckets.bit_length() - 1
    return F.shiftright(F.xxhash64(*cols), 64 - bits) if bits else F.lit(0).cast("long")


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` is a table of files just read, perhaps with columns or rows left out."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.getClass().getSimpleName() == "LogicalRelation"


def row_order(df: DataFrame) -> Column:
    """A long that grows along the rows of ``df``, the number of the row's file or partition above 33 bits.

    Files are read in any order, the largest ones first; in a table just read rows are therefore
    numbered by the numbers in the names of Spark's files and by their places in them.
    """
    if not is_scan(df):
        return F.monotonically_increasing_id()
    number = lambda form: F.coalesce(
        F.expr(f"try_cast(regexp_extract(_metadata.file_name, '{form}', 1) as long)"), F.lit(0)
    )
    file = number("^part-([0-9]+)") * 1024 + number("-c([0-9]+)[.]")
    return F.shiftleft(file, 33) + F.col("_metadata.row_index")
