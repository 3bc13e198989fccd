"""Folders that driver and executors share, staged tables, and files by uri."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """A folder of this session below spark.checkpoint.dir, which every executor can reach.

    Only where the cluster names none and all runs on one machine (tests) a temporary folder is set instead.
    """
    app = spark.sparkContext.applicationId
    if app not in _made:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="terralot-")
            spark.sparkContext.setCheckpointDir(base)
        elif not urlparse(base).scheme:
            base = "file://" + os.path.abspath(base)
        _made[app] = f"{base.rstrip('/')}/terralot-{uuid.uuid4().hex[:12]}"
        atexit.register(remove, spark, _made[app])
    return _made[app]


def remove(spark: SparkSession, uri: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended before; the folder is then the cluster's to clean
        pass


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table in the shared folder and read back: its lineage ends there."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def find(spark: SparkSession, patterns: str) -> list[str]:
    """The files of comma-separated globs, each once, sorted. None at all is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    for pattern in filter(None, map(str.strip, patterns.split(","))):
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        found |= {s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []}
    if not found:
        raise FileNotFoundError(f"no file for {patterns}")
    return sorted(found)


def plain(uri: str) -> str | None:
    """The path of a local (or mounted) file, else None."""
    u = urlparse(uri)
    return u.path if u.scheme in ("", "file") else None


def _system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def read_bytes(uri: str) -> bytes:
    if path := plain(uri):
        with open(path, "rb") as f:
            return f.read()
    system, path = _system(uri)
    with system.open_input_file(path) as f:
        return f.read()


def open_read(uri: str):
    """A seekable binary file."""
    if path := plain(uri):
        return open(path, "rb")
    system, path = _system(uri)
    return system.open_input_file(path)


def open_write(uri: str):
    if path := plain(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    system, path = _system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def write_whole(uri: str, data: bytes) -> None:
    """Written under a name of its own and then renamed, so a task that runs again leaves a whole file."""
    part = f"{uri}.{uuid.uuid4().hex[:8]}.part"
    with open_write(part) as f:
        f.write(data)
    if path := plain(uri):
        os.replace(plain(part), path)
    else:
        system, path = _system(uri)
        system.move(_system(part)[1], path)
