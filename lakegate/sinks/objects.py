"""Single objects that only one writer can make, and claims built on them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from uuid import uuid4

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs share this many claims: the bound on what an ingest collects and creates.
CLAIM_SLOTS = 1024


class RunClaimedError(RuntimeError):
    """Another ingest is working on runs of the same claim."""


def _file(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def create_object(spark: SparkSession, path: str, text: str, kind: str = "An object") -> None:
    """Write ``text`` to ``path``, or raise ``FileExistsError`` and leave what is there.

    The file system's own exclusive create decides, so of two writers one fails.
    """
    files, target = _file(spark, path)
    try:
        stream = files.create(target, False)
    except Py4JJavaError as error:
        if files.exists(target):
            raise FileExistsError(f"{kind} exists already: {path}") from error
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def claims_folder(root: str) -> str:
    return f"{root.rstrip('/')}/_claims"


@contextmanager
def claimed_runs(
    spark: SparkSession, runs: DataFrame, root: str, slots: int = CLAIM_SLOTS
) -> Iterator[str]:
    """Hold the claims of all ``run_id`` of ``runs``; the name of their holder.

    A claim is one object per slot, and a run belongs to the slot of its hash, so at most
    ``slots`` numbers come to the driver however many runs there are. Slots are taken in order:
    of two ingests that share one, the second to reach it gives back what it has and gets
    :class:`RunClaimedError`, before it has read a manifest or written a page. Two ingests
    without a common run can share a slot; the one refused may try again. Claims go when the
    block ends, in success or failure; what a lost driver leaves stays until
    :func:`break_claims`. NULL run ids claim nothing.
    """
    slot = F.pmod(F.xxhash64("run_id"), F.lit(slots)).alias("slot")
    wanted = runs.filter(F.col("run_id").isNotNull()).select(slot).distinct()
    holder, held = uuid4().hex, []
    try:
        for number in sorted(row.slot for row in wanted.collect()):
            path = f"{claims_folder(root)}/{number}"
            try:
                create_object(spark, path, holder)
            except FileExistsError as error:
                raise RunClaimedError(f"Another ingest holds the claim {path}") from error
            held.append(path)
        yield holder
    finally:
        for path in held:
            files, target = _file(spark, path)
            files.delete(target, False)


def break_claims(spark: SparkSession, root: str, before: datetime) -> int:
    """Remove claims taken before a moment (of a driver known to be lost); how many there were."""
    files, folder = _file(spark, claims_folder(root))
    if not files.exists(folder):
        return 0
    limit = before.timestamp() * 1000
    old = [each.getPath() for each in files.listStatus(folder) if each.getModificationTime() < limit]
    return sum(files.delete(path, False) for path in old)
