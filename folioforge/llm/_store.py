"""Files in the folder that the driver and all executors share (spark.checkpoint.dir)."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the session's checkpoint folder. Where none is set, a session on this machine alone gets one of
    its own; on a cluster that is an error, as its machines share no temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._conf.get("spark.checkpoint.dir")
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "folioforge-shared")
    _MADE.append(f"{root.rstrip('/')}/folioforge-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear() -> None:
    """Remove the folders that this driver has made. Results that still read them must have been written before."""
    import shutil

    while _MADE:
        uri = _MADE.pop()
        path = _plain(uri)
        if path is not None:
            shutil.rmtree(path, ignore_errors=True)
            continue
        from pyarrow import fs

        where, name = fs.FileSystem.from_uri(uri)
        if where.get_file_info(name).type != fs.FileType.NotFound:
            where.delete_dir(name)


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: its lineage is cut and survives lost executors."""
    schema = df.schema
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(schema).parquet(f"{folder}/{name}")


def _plain(uri: str) -> str | None:
    u = urlparse(uri)
    return unquote(u.path) if u.scheme in ("", "file") else None


def put(uri: str, array: np.ndarray) -> None:
    """Write ``array`` under a temporary name, then rename: a task that runs twice leaves one whole file."""
    path = _plain(uri)
    if path is None:
        from pyarrow import fs

        where, name = fs.FileSystem.from_uri(uri)
        where.create_dir(os.path.dirname(name), recursive=True)
        with where.open_output_stream(name + (part := f".{uuid.uuid4().hex}")) as f:
            f.write(np.ascontiguousarray(array).tobytes())
        where.move(name + part, name)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    np.ascontiguousarray(array).tofile(part)
    os.replace(part, path)


def mapped(uri: str, dtype) -> np.ndarray:
    """The array of ``uri``, memory-mapped. A file of another kind of store is copied once for each machine first; a copy that is
    lost with its machine is made again."""
    path = _plain(uri)
    if path is None:
        path = _LOCAL.get(uri)
        if path is None:
            from pyarrow import fs

            where, name = fs.FileSystem.from_uri(uri)
            path = os.path.join(tempfile.gettempdir(), f"folioforge-{hashlib.sha256(uri.encode()).hexdigest()[:32]}")
            if not os.path.exists(path):
                part = f"{path}.{uuid.uuid4().hex}"
                with open(part, "wb") as out, where.open_input_stream(name) as f:
                    while chunk := f.read(1 << 24):
                        out.write(chunk)
                os.replace(part, path)
            _LOCAL[uri] = path
    if os.path.getsize(path) == 0:
        return np.zeros(0, dtype=dtype)
    return np.memmap(path, dtype=dtype, mode="r")
