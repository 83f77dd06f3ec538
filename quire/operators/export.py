"""Carrying out an export plan: files are copied by the tasks that hold their rows, each with a word on how it went."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that are held of a file at a time.
PIECE = 1 << 20


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def copied(source: str, target: str) -> str:
    """Copy by pieces under a passing name, then rename: a target is whole or absent.  Returns the SHA-256 of its bytes."""
    there, name = _opened(source)
    here, to = _opened(target)
    here.create_dir(to.rsplit("/", 1)[0], recursive=True)
    part, digest = f"{to}.{uuid.uuid4().hex}.part", hashlib.sha256()
    try:
        with there.open_input_stream(name) as read, here.open_output_stream(part) as write:
            while piece := read.read(PIECE):
                digest.update(piece)
                write.write(piece)
        here.move(part, to)
    except BaseException:
        if here.get_file_info(part).type != fs.FileType.NotFound:
            here.delete_file(part)
        raise
    return digest.hexdigest()


def removed(target: str) -> None:
    here, to = _opened(target)
    here.delete_file(to)


def carry_out(plan: DataFrame, orphans: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """source, target, action, done, sha256, error for every row of the plan (source, target, action as export_plan gives
    them), and for orphans (target) that are deleted.  A file that fails is reported and stops no other; collisions and
    unchanged targets are left alone; a dry run touches nothing.

    The result is not lazy work to be repeated: write it down once, a second evaluation copies again (to the same end)."""
    rows = plan.select("source", "target", "action")
    if orphans is not None:
        rows = rows.unionByName(orphans.select(F.lit(None).cast("string").alias("source"), "target", F.lit("delete").alias("action")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, digests, errors = [], [], []
            for source, target, action in zip(*[c.to_pylist() for c in batch.columns]):
                digest = error = None
                ran = False
                if not dry_run and action in ("write", "delete"):
                    try:
                        digest = copied(source, target) if action == "write" else removed(target)
                        ran = True
                    except Exception as e:  # one bad file must not end the others
                        error = f"{type(e).__name__}: {e}"[:500]
                done.append(ran)
                digests.append(digest)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.bool_()), pa.array(digests, pa.string()), pa.array(errors, pa.string())], names=["source", "target", "action", "done", "sha256", "error"])

    return rows.repartition("target").mapInArrow(run, "source string, target string, action string, done boolean, sha256 string, error string")


def summary(report: DataFrame) -> DataFrame:
    """action, n, done, failed."""
    return report.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("done"), 1)).alias("done"), F.count("error").alias("failed"))
