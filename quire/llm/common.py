"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the membership bitmap: 512 KB, whatever the size of the key set.
BITMAP_BITS = 1 << 22
#: Keys with more than 1/HOT_PARTS of all rows are "hot"; there are fewer than HOT_PARTS of them.
HOT_PARTS = 1024


#: Scratch paths of the run that this thread is in.
_run: ContextVar[list[str] | None] = ContextVar("quire_scratch", default=None)


@contextmanager
def scratch_run() -> Iterator[list[str]]:
    """A run: the list gathers the scratch paths that are given out inside, those of no other thread or run."""
    paths: list[str] = []
    token = _run.set(paths)
    try:
        yield paths
    finally:
        _run.reset(token)


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/quire/{tag}-{uuid.uuid4().hex}"
    own = _run.get()
    if own is not None:
        own.append(path)
    return path


def release(spark: SparkSession, paths: list[str], keep: DataFrame | None = None) -> None:
    """Delete scratch paths of a run (and take them off its list), but for those whose files `keep` reads."""
    files = keep.inputFiles() if keep is not None else []
    jvm = spark.sparkContext._jvm
    for path in list(paths):
        if not any(f"{path}/" in f for f in files):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            paths.remove(path)


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors.

    The driver then settles: an operator of many steps would else gather plans and generated classes of all of them in it."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    settle(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it has ended (those of what `saved` writes are of no further use)."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def trim() -> None:
    """Give memory that a Python worker has freed back to the system: workers stay for later tasks, of other stages too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trim_jvm(spark: SparkSession) -> bool:
    """As trim for the driver's JVM, whose compilers and hundreds of threads leave freed native memory in the C library; whether it could."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    try:
        # by the interface: the server's own class is not open to calls
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = gateway.new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # another JVM or C library
        return False
    return True


def settle(spark: SparkSession) -> None:
    """Collect garbage in the driver: only then does Spark learn which broadcasts and shuffles nobody refers to, and deletes them."""
    trim()
    spark.sparkContext._jvm.System.gc()
    trim_jvm(spark)


def bits_for(keys: int, most: int = 1 << 26) -> int:
    """A power of two with about 16 bits for each key, 8 MB at most; beyond that a filter lets more keys pass that it does not hold."""
    return min(most, 1 << max(12, (16 * keys - 1).bit_length() if keys else 0))


def _slots(key: Column, bits: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key) if not i else F.xxhash64(key, F.lit(i)), F.lit(bits).cast("long")) for i in range(probes)]


def bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS, probes: int = 1) -> DataFrame:
    """One row, one array of bits/64 longs: a Bloom filter.  Its size does not depend on the keys."""
    spark, words = keys.sparkSession, bits // 64
    slots = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_slots(F.col(key), bits, probes))).alias("slot"))
    own = slots.select(F.shiftright("slot", 6).alias("w"), F.expr("1L").alias("one"), F.col("slot").bitwiseAND(F.lit(63)).cast("int").alias("b"))
    own = own.select("w", F.expr("shiftleft(one, b)").alias("bits"))
    return (
        own.unionByName(spark.range(words).select(F.col("id").alias("w"), F.expr("0L").alias("bits")))
        .groupBy("w").agg(F.bit_or("bits").alias("bits"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "bits"))), lambda x: x["bits"]).alias("bitmap"))
    )


def may_hold(bits_df: DataFrame, key: Column, bits: int = BITMAP_BITS, probes: int = 1) -> Column:
    """True for every key in the bitmap and for few others; false for a null key."""
    held, out = bits_df.scalar(), key.isNotNull()
    for slot in _slots(key, bits, probes):
        out = out & (F.getbit(F.element_at(held, F.shiftright(slot, 6).cast("int") + 1), slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def shuffled(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input.  Spark guesses its size from files and column types, far too low after
    an explode or for long binary columns, and would collect and broadcast it by that guess; sort-merge join never does."""
    return side.hint("merge")


def hot_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """left ⟕ right on a unique key of right, whose `weight` says how many left rows carry the key.

    Keys with over 1/HOT_PARTS of the rows number under HOT_PARTS, so that part of `right` is broadcast and
    hot rows of `left` never meet in one task.  The rest is an ordinary shuffled join."""
    least = max(1000, total // HOT_PARTS)
    hot = right.where(F.col(weight) > least)
    keys = F.broadcast(hot.select(key))
    return left.join(F.broadcast(hot), key).unionByName(left.join(keys, key, "left_anti").join(shuffled(right.where(F.col(weight) <= least)), key, "left"))


def spread_join(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """As hot_join, for rows of `right` that are wide: only keys and numbers are broadcast.

    The row of a hot key is copied, once for each 1/HOT_PARTS of the left rows that carry it, and those rows are dealt
    over the copies by their own hash.  That makes fewer than HOT_PARTS copies more than there are keys."""
    least = max(1000, total // HOT_PARTS)
    copies = F.ceil(F.col(weight) / least).cast("int")
    hot = right.where(F.col(weight) > least).select(key, copies.alias("__copies"))
    dealt = F.coalesce(F.pmod(F.xxhash64(*left.columns), F.col("__copies")).cast("int"), F.lit(0))
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("__copy", dealt).drop("__copies")
    wide = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.greatest(copies, F.lit(1)) - 1)))
    return dealt.join(shuffled(wide), [key, "__copy"], "left").drop("__copy")


def components(edges: DataFrame, tag: str = "cc", most: int = 60) -> DataFrame:
    """Connected components of (a long, b long) edges: rows (node, root), root the smallest node of the component.

    Alternating large-star and small-star steps; each round is written to the shared folder.  A node's neighbours are
    reduced by a min aggregate and rejoined, never gathered into one row."""
    e, was = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), tag), None
    for _ in range(most):
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == was:
            break
        was = now
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = saved(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"), tag)
        large = hot_join(both.where("v > u"), low, "u", "n", 2 * now[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(shuffled(low2), "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        e = saved(small.select("u", "v"), tag)
    else:
        raise RuntimeError(f"components: not stable after {most} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


ROW = "__quire_row"


def row_key(key: str, text: str) -> Column:
    """Identity of a row's document and text, 128 bits: equal for repeated rows."""
    own = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (key, text)]
    return F.unhex(F.md5(F.concat(own[0], F.lit("\u0001"), own[1])))


def rejoin(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """docs joined to a side table on ROW (left or left_anti); rows that cannot match skip the shuffle."""
    hold = bitmap(side, ROW)
    maybe = may_hold(hold, F.col(ROW))
    near = docs.where(maybe).join(shuffled(side), ROW, how)
    rest = docs.where(~maybe)
    for f in near.schema.fields:
        if f.name not in docs.columns:
            rest = rest.withColumn(f.name, F.lit(None).cast(f.dataType))
    return near.select(*rest.columns).unionByName(rest)
