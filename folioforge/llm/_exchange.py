"""Columnar exchange: numpy arrays travel between tasks as a few binary rows instead of a row for each value.

A map task keeps its values in arrays, sorts and pre-aggregates them, cuts them by bucket and emits one
row (bucket, payload) for each bucket; Spark shuffles these rows by bucket, and a reduce task decodes
all payloads of its bucket. Arrays are stored as byte planes (sorted numbers as differences) and
compressed, which takes 2 to 8 bytes a value.

Buckets are as many as the session's shuffle partitions, so a bucket's size is set the way that
partition sizes are set for any other shuffle.
"""

from __future__ import annotations

import struct
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BLOCK = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("payload", T.BinaryType())])
ARROW = pa.schema([("bucket", pa.int32()), ("payload", pa.binary())])
U64 = np.uint64
_OWN = threading.local()


def _coder(kind: str, **options):
    """This thread's compressor or decompressor: making one costs more than a small payload."""
    import zstandard

    made = _OWN.__dict__
    name = (kind, *options.values())
    if name not in made:
        made[name] = getattr(zstandard, kind)(**options)
    return made[name]


def buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def encode(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Pack arrays; a leading sorted integer array is kept as differences."""
    head, body = [struct.pack("<I", len(arrays))], []
    for a in arrays:
        kind = a.dtype.str[1:].encode()
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.zeros((a.dtype.itemsize, 0), np.uint8)
        head.append(struct.pack("<2sQ", kind, len(a)))
        body.append(np.ascontiguousarray(planes).tobytes())
    return _coder("ZstdCompressor", level=level).compress(b"".join(head + body))


def decode(payload: bytes) -> list[np.ndarray]:
    raw = _coder("ZstdDecompressor").decompress(payload)
    n, at, kinds, out = struct.unpack_from("<I", raw)[0], 4, [], []
    for _ in range(n):
        kinds.append(struct.unpack_from("<2sQ", raw, at))
        at += struct.calcsize("<2sQ")
    for kind, size in kinds:
        dtype = np.dtype("<" + kind.decode())
        planes = np.frombuffer(raw, np.uint8, dtype.itemsize * size, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(size))
        at += dtype.itemsize * size
    return out


def deltas(sorted_values: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned values, the first being the value itself; ``np.cumsum`` undoes it."""
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket of uniform hashes by range, so that buckets in order are globally sorted."""
    return ((h >> U64(32)) * U64(n)) >> U64(32)


def cut(sorted_hashes: np.ndarray, n: int) -> np.ndarray:
    """Places where sorted hashes change bucket: n + 1 of them."""
    return np.searchsorted(bucket_of(sorted_hashes, n), np.arange(n + 1, dtype=U64))


def rows(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.binary())], schema=ARROW
    )


def emit(df: DataFrame, run: Callable) -> DataFrame:
    """``run``: iterator of Arrow batches -> iterator of batches of (bucket, payload)."""
    return df.mapInArrow(run, BLOCK)


def seal(parts: list[bytes]) -> bytes:
    """The payloads of a bucket's sub-buckets, in order, as one payload; an empty one is b""."""
    return struct.pack(f"<I{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def unseal(payloads: list[bytes], k: int, skip: int = 0) -> Iterator[list[np.ndarray]]:
    """The arrays of sub-bucket ``k``, payload by payload. ``skip``: bytes before the sealed part.

    A reducer that goes through its sub-buckets one by one holds its payloads in compressed form and one
    sub-bucket's arrays.
    """
    for p in payloads:
        n = struct.unpack_from("<I", p, skip)[0]
        sizes = struct.unpack_from(f"<{n}Q", p, skip + 4)
        if sizes[k]:
            at = skip + 4 + 8 * n + sum(sizes[:k])
            yield decode(memoryview(p)[at : at + sizes[k]])


def release() -> None:
    """Give freed memory back to the system: Python workers live on from group to group and from stage to stage."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def gather(blocks: DataFrame, schema: T.StructType | str, reduce: Callable) -> DataFrame:
    """``reduce(bucket, payloads)`` for every bucket; it gives an Arrow table of ``schema``, or one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, payloads = 0, []
        for b in batches:
            if b.num_rows:
                bucket = b.column(0)[0].as_py()
                payloads += b.column(1).to_pylist()
        got = reduce(bucket, payloads)
        del payloads
        for table in [got] if isinstance(got, pa.Table) else got:
            yield from table.to_batches()
        del got
        release()

    return blocks.select("bucket", "payload").groupBy("bucket").applyInArrow(run, schema)


def in_batches(it, key: str = "doc_id", text: str = "text", limit: int = 4 << 20):
    """(keys, texts) parts of Arrow batches; ``keys`` as a list."""
    from folioforge.llm import _arrow

    for batch in it:
        keys, texts = batch.column(key).to_pylist(), batch.column(text).to_pylist()
        for lo, hi in _arrow.parts(texts, limit):
            yield keys[lo:hi], texts[lo:hi]


def firsts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64)
    new = np.empty(len(sorted_values), dtype=bool)
    new[0] = True
    np.not_equal(sorted_values[1:], sorted_values[:-1], out=new[1:])
    return np.flatnonzero(new)
