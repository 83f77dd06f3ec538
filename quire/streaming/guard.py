"""Streaming guard: chunks of a page arrive in order, a page is flagged once its tail loops.

A page's state is its last LOOP_WINDOW characters; pages are kept in buckets by their key.  It leaves the state with its last chunk; what is never ended leaves it
after a time without chunks (a timer), and a page is then reported as it stands.  Of a flagged page only the flag is kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quire.functions.guards import LOOP_WINDOW, WINDOW, is_runaway
from quire.operators.dedup import shared_folder

OUT = "page_key string, chars bigint, runaway boolean, ended boolean"
#: Milliseconds without a chunk after which a page is given up.
IDLE_MS = 3_600_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Pages share a group of rows and its state: a group costs milliseconds, whatever it holds.  A checkpoint holds for one number.
BUCKETS, BUCKET_ROWS = 1024, 2000
STATE = "pages array<string>, tails array<string>, totals array<bigint>, flagged array<boolean>, seen array<bigint>"


def judge(idle_ms: int | None = None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The step of a bucket: by page its state has the last LOOP_WINDOW characters, the length so far, whether it was flagged and
    when its last chunk came."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {page: x for page, *x in zip(*state.get)} if state.exists else {}
        now = 0 if idle_ms is None else state.getCurrentProcessingTimeMs()
        came, said = {}, []
        for f in [] if state.hasTimedOut else frames:
            for page, *row in zip(*[f[c].tolist() for c in ("page_key", "seq", "chunk", "last")]):
                came.setdefault(page, []).append(row)
        for page, rows in came.items():
            (tail, total, flagged, _), ended = held.pop(page, ("", 0, False, 0)), False
            for _, chunk, last in sorted(rows, key=lambda row: row[0]):
                ended = ended or bool(last)
                if not flagged:
                    total += len(chunk)
                    tail = (tail + chunk)[-LOOP_WINDOW:]
                    flagged = total >= WINDOW and bool(is_runaway(tail))
            said.append((page, total, flagged, ended))
            if not ended:
                held[page] = ["" if flagged else tail, total, flagged, now]
        if idle_ms is not None:
            for page in [p for p, x in held.items() if x[3] + idle_ms <= now]:
                _, total, flagged, _ = held.pop(page)
                said.append((page, total, flagged, True))
        if held:
            state.update(tuple(map(list, zip(*[(page, *x) for page, x in held.items()]))))
            if idle_ms is not None:
                state.setTimeoutDuration(max(1, min(x[3] for x in held.values()) + idle_ms - now))
        elif state.exists:
            state.remove()
        if said:
            yield pd.DataFrame(said, columns=["page_key", "chars", "runaway", "ended"])

    return step


def guard_stream(chunks: DataFrame, idle_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """chunks (streaming): page_key, seq, chunk, and `last` on a page's last chunk if the source tells it.  Emits page_key,
    chars, runaway, ended after each batch.  With `idle_ms` pages without chunks for so long end, too; such a query runs on
    until it is stopped, as timers may fire without data (so it does not go with the trigger availableNow).  Needs a session with the RocksDB state store (see PROVIDER)."""
    rows = chunks if "last" in chunks.columns else chunks.withColumn("last", F.lit(False))
    rows = rows.select("page_key", "seq", F.coalesce("chunk", F.lit("")).alias("chunk"), F.coalesce("last", F.lit(False)).alias("last"))
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("page_key"), F.lit(buckets)))
    return rows.groupBy("bucket").applyInPandasWithState(judge(idle_ms), OUT, STATE, "Update", timeout)


def write_guarded(chunks: DataFrame, out: str, checkpoint: str, idle_ms: int | None = None, buckets: int = BUCKETS, **trigger: object):
    """Starts a query that writes each batch to a folder of its number, so a batch that is run again after a failure
    replaces what it wrote; returns the query."""
    run = guard_stream(chunks, idle_ms, buckets).writeStream.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
    return run.outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def last_words(spark, out: str) -> DataFrame:
    """page_key, chars, runaway: the last word on each page that write_guarded has written."""
    said = spark.read.schema(f"{OUT}, batch bigint").parquet(out)
    return said.groupBy("page_key").agg(F.max(F.struct("batch", "ended", "chars", "runaway")).alias("x")).select("page_key", "x.chars", "x.runaway")


def guard_files(chunks: DataFrame) -> DataFrame:
    """page_key, chars, runaway of every page: chunks are written to the shared folder, read from there as a stream until
    all are read, and the last word on each page is returned.  Where chunks have `last`, ended pages leave no state."""
    spark = chunks.sparkSession
    shared_folder(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/guard-{uuid.uuid4().hex}"
    last = F.col("last") if "last" in chunks.columns else F.lit(False)
    chunks.select("page_key", F.col("seq").cast("long").alias("seq"), "chunk", last.alias("last")).write.parquet(f"{base}/in")
    was = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        stream = spark.readStream.schema("page_key string, seq long, chunk string, last boolean").parquet(f"{base}/in")
        # so many buckets that one's rows stay the same as the table grows (counted from the files' footers)
        buckets = max(BUCKETS, spark.read.parquet(f"{base}/in").count() // BUCKET_ROWS)
        write_guarded(stream, f"{base}/out", f"{base}/state", buckets=buckets).awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if was is None else spark.conf.set(PROVIDER, was)
    return last_words(spark, f"{base}/out")
