"""One active run a table root (T1): a lease with an expiry for dead holders.

A lease is a file ``_lease/<number>`` that names its holder and when it ends.
It is written aside and renamed into place, which the store refuses if the
number is taken (atomic on stores with an atomic rename, as Spark's own
streaming checkpoints need it). The highest number counts; whoever finds it
ended or given back creates the next one, so of two that try, one wins, and a
lease is never removed under a holder.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class LeaseHeld(RuntimeError):
    """Another run holds the lease."""


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/_lease"


def _context(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = path.getFileSystem(conf)
    return jvm, fs, jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)


def _create(spark: SparkSession, folder: str, number: int, said: dict) -> bool:
    """Put ``said`` at ``number``; False if that number is taken."""
    jvm, fs, context = _context(spark, folder)
    aside = jvm.org.apache.hadoop.fs.Path(f"{folder}/_new-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(json.dumps(said).encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    keep = spark.sparkContext._gateway.new_array(rename, 1)
    keep[0] = rename.NONE
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}"), keep)
        return True
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception.toString()):
            return False
        raise


def current(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(number, content) of the lease with the highest number; (0, None) without one."""
    folder = _folder(root)
    jvm, fs, _ = _context(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not fs.exists(path):
        return 0, None
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    number = max((int(n) for n in names if n.isdigit()), default=0)
    if not number:
        return 0, None
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:012d}"))
    try:
        said = json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
    return number, said


def acquire(spark: SparkSession, root: str, holder: str, seconds: float, now: float | None = None) -> int:
    """Take the lease for ``seconds``; its number. Raises LeaseHeld while another holder's runs."""
    now = time.time() if now is None else now
    number, said = current(spark, root)
    if said is not None and said["holder"] and said["ends"] > now:
        raise LeaseHeld(f"{root}: run {said['holder']} holds the lease for {said['ends'] - now:.0f} s more")
    if not _create(spark, _folder(root), number + 1, {"holder": holder, "ends": now + seconds}):
        raise LeaseHeld(f"{root}: another run has just taken the lease")
    return number + 1


def release(spark: SparkSession, root: str, number: int) -> None:
    """Give lease ``number`` back; does nothing where it has ended and was taken over."""
    if current(spark, root)[0] == number:
        _create(spark, _folder(root), number + 1, {"holder": None, "ends": 0.0})


@contextlib.contextmanager
def held(spark: SparkSession, root: str, holder: str, seconds: float | None):
    """The lease for the time of a block; ``seconds=None`` takes none."""
    number = None if seconds is None else acquire(spark, root, holder, seconds)
    try:
        yield number
    finally:
        if number is not None:
            release(spark, root, number)
