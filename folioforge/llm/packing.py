"""Harmonic packing of token sequences.

A document's tokens are cut into pieces, each of which belongs to a reciprocal-capacity class: class j
holds the lengths in (C / (j + 1), C / j], and every bin of class j takes exactly j pieces. So a bin
needs no search, and every worker fills the bins of each class on its own, with no shuffle.

Harmonic packing of uncut lengths pads up to half of a bin (a piece of C / 2 + 1 tokens sits alone). As
pieces may be cut freely, a document gives whole sequences first and then, while more than ``rest``
tokens are left, a piece of the largest class width floor(C / j) that fits; its last piece of at most
``rest`` tokens goes to its own class, where padding is at most the piece length less one.

Bins that a worker cannot fill are at most one for each class; their pieces are put together first-fit at
the worker's end. A sequence is numbered by its partition and its place in it, so a task that runs again
after a lost executor gives the same rows.

Defined cases: a null or empty text is the end token alone; an empty table gives an empty table; a very long text
is cut into full sequences; repeated rows are packed each; pieces of one length are put into bins in the order of their rows;
extra columns are not returned.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow

CAPACITY, REST = 1024, 64
#: sequences that one partition can number
PER_TASK = 1 << 33

PIECES = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def cuts(n: int, capacity: int = CAPACITY, rest: int = REST) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left > rest:
        width = capacity // -(-capacity // left)  # the widest class width that is not over what is left
        out.append(width)
        left -= width
    if left:
        out.append(left)
    return out


class Bins:
    """The open bins of one worker: one for each class, closed when it has its fixed count."""

    def __init__(self, first: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.open = capacity, first, {}

    def number(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, piece: list):
        """Take ``piece`` (its length first); give the pieces of a bin that is full by now, or none."""
        j = self.capacity // piece[0]
        got = self.open.setdefault(j, [])
        got.append(piece)
        if len(got) < j:
            return None
        del self.open[j]
        return got

    def rest(self):
        """Bins of the pieces that are left, first-fit by decreasing length."""
        left = sorted((p for got in self.open.values() for p in got), key=lambda p: -p[0])
        bins: list[list] = []
        room: list[int] = []
        for p in left:
            k = next((k for k, r in enumerate(room) if r >= p[0]), None)
            if k is None:
                bins.append([])
                room.append(self.capacity)
                k = len(room) - 1
            bins[k].append(p)
            room[k] -= p[0]
        self.open = {}
        return bins


def tokenizer(path: str):
    """Function from texts to arrays of ids. ``path``: a tokenizers JSON file.

    Ids are those of tokenizers with its own settings, so the vocabulary's special tokens are found in texts. Where the ranks
    of the same vocabulary lie beside it (``.tiktoken``), texts of plain Latin letters without special tokens go the faster way of
    tiktoken, which gives the same ids; any other text goes to tokenizers itself, as the two libraries' Unicode tables may
    differ in rarer scripts.
    """
    import base64
    import os
    import re

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    exact = Tokenizer.from_file(path)
    ranks_path = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks_path):
        return lambda texts: [np.asarray(e.ids, dtype="<u4") for e in exact.encode_batch(texts, add_special_tokens=False)]
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("fast", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = [re.escape(t.content) for t in exact.get_added_tokens_decoder().values()]
    other = re.compile("|".join(["[^\x00-ɏ‐-‧€]", *added]))

    def encode(texts):
        out = []
        for t in texts:
            if other.search(t):
                out.append(np.asarray(exact.encode(t, add_special_tokens=False).ids, dtype="<u4"))
            else:
                out.append(np.asarray(fast.encode_ordinary(t), dtype="<u4"))
        return out

    return encode


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    rest: int = REST,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: the id, its place in the document and in its sequence, and its ids' checksum (and ids)."""
    src = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    out = T.StructType([src.schema[0], *PIECES, *extra])

    def run(it):
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, arrow = tokenizer(tokenizer_path), to_arrow_schema(out)
        bins = Bins(TaskContext.get().partitionId() * PER_TASK, capacity)
        rows: list[tuple] = []

        def close(got):
            number, offset = bins.number(), 0
            for p in got:
                rows.append((*p[1:5], p[0], p[5], number, offset, *p[6:]))
                offset += p[0]

        def flush():
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in range(8 + len(extra))]
            doc, start, crc, total, length, _, number, offset, *ids = cols
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip((doc, start, length, crc, total, number, offset, *ids), arrow, strict=True)],
                schema=arrow,
            )

        for batch in it:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _arrow.parts(texts):
                for key, ids in zip(keys[lo:hi], encode([t or "" for t in texts[lo:hi]]), strict=True):
                    raw, n, at = ids.tobytes() + end_id.to_bytes(4, "little"), len(ids) + 1, 0
                    for length in cuts(n, capacity, rest):
                        part = raw[4 * at : 4 * (at + length)]
                        more = [np.frombuffer(part, dtype="<u4").tolist()] if with_ids else []
                        got = bins.add([length, key, at, zlib.crc32(part), n, None, *more])
                        at += length
                        if got:
                            close(got)
                if len(rows) >= 20_000:
                    yield flush()
        for got in bins.rest():
            close(got)
        yield flush()

    return src.mapInArrow(run, out)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(_arrow.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
