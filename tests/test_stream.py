from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from quire.streaming import guard

pytest.importorskip("google.protobuf", reason="the state server of Spark speaks protobuf")

CHUNKS = "page_key string, seq long, chunk string, last boolean"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set(guard.PROVIDER, guard.ROCKS)
    yield
    spark.conf.unset(guard.PROVIDER)


def test_guard_over_file_stream(spark, tmp_path):
    """A looping page is flagged, a plain one is not; chunks of one page come in two files."""
    loop = [("loop", i, "then to point %d " % i) for i in range(400)]
    plain = [("plain", i, "word%d and %d other things. " % (i * 7919 % 1009, i * i)) for i in range(60)]
    schema = "page_key string, seq long, chunk string"
    for part in (0, 1):
        spark.createDataFrame([x for x in loop + plain if x[1] % 2 == part or x[0] == "loop" and part == 0], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    chunks = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = guard.guard_stream(chunks).writeStream.format("memory").queryName("guarded").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {}
    for r in spark.table("guarded").collect():
        got[r.page_key] = got.get(r.page_key, False) or r.runaway
    assert got == {"loop": True, "plain": False}


def test_ended_pages_leave_the_state_and_a_restart_goes_on(spark, tmp_path):
    """Two runs over one checkpoint say what one run says; after the last chunks no state is left."""
    rows = [(f"p{k}", i, f"chunk {i * 31 % 17} of {k}. ", i == 5) for k in range(6) for i in range(6)] + [("loop", i, "then to point then to point " * 40, i == 5) for i in range(6)]
    part = lambda lo, hi: spark.createDataFrame([r for r in rows if lo <= r[1] < hi], CHUNKS).coalesce(1)
    read = lambda name: spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    part(0, 3).write.mode("append").parquet(str(tmp_path / "in"))
    first = guard.write_guarded(read("in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert first.awaitTermination(120)
    assert first.lastProgress["stateOperators"][0]["numRowsTotal"] > 0
    part(3, 6).write.mode("append").parquet(str(tmp_path / "in"))
    again = guard.write_guarded(read("in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert again.awaitTermination(120)
    assert again.lastProgress["stateOperators"][0]["numRowsTotal"] == 0

    part(0, 6).write.parquet(str(tmp_path / "in1"))
    assert guard.write_guarded(read("in1"), str(tmp_path / "out1"), str(tmp_path / "cp1")).awaitTermination(120)
    words = lambda name: sorted(map(tuple, guard.last_words(spark, str(tmp_path / name)).collect()))
    assert words("out") == words("out1") and len(words("out")) == 7
    assert [k for k, _, bad in words("out") if bad] == ["loop"]


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 5, False, True)], guard.OUT)
    for _ in range(2):
        rows.write.mode("overwrite").parquet(str(tmp_path / "out/batch=3"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert [tuple(r) for r in guard.last_words(spark, str(tmp_path / "out")).collect()] == [("a", 5, False)]


def test_pages_without_an_end_are_given_up(spark, tmp_path):
    spark.createDataFrame([("left", 0, "a start", False)], CHUNKS).write.parquet(str(tmp_path / "in"))
    chunks = spark.readStream.schema(CHUNKS).parquet(str(tmp_path / "in"))
    run = guard.write_guarded(chunks, str(tmp_path / "out"), str(tmp_path / "cp"), idle_ms=1000, processingTime="1 second")
    try:
        for _ in range(60):
            time.sleep(1)
            p = run.lastProgress
            if p and p["batchId"] > 1 and p["stateOperators"] and p["stateOperators"][0]["numRowsTotal"] == 0:
                break
        else:
            pytest.fail("the page is still held")
    finally:
        run.stop()
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("ended")).select("page_key", "chars").collect()[0] == ("left", 7)
