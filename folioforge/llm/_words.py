"""Vectorised tokenising and hashing of whole texts, shared by the text operators.

Every helper works on one packed byte buffer per batch of documents, so cost is a few
numpy passes per byte and memory is a small multiple of the batch. Batches are cut by
bytes (``batches``), never by dropping or shortening a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_M1, _M2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

#: word characters of the two word rules, by UTF-8 byte (every byte of a non-ASCII letter counts)
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of ``x`` over the 64 bits of the result."""
    x = x ^ (x >> U64(30))
    x = x * _M1
    x ^= x >> U64(27)
    x *= _M2
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * _ODD)
_BASE = U64(0xD6E8FEB86659FD93)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), _BASE if kind == "up" else _INV, dtype=U64)
        step[0] = 1
        have = _POWERS[kind] = np.cumprod(step, dtype=U64)
    return have[:n]


def pack(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts (null: empty), a newline after each; and where each text starts, with the end last."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t for t in texts]
    data = b"\n".join(raw) + b"\n"
    if lower:
        data = data.lower()  # bytes.lower changes A-Z only
    starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    return np.frombuffer(data, dtype=np.uint8), starts


def spans(buf: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that ``member`` allows."""
    inside = np.empty(len(buf) + 1, dtype=bool)
    inside[-1] = False
    np.take(member, buf, out=inside[:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans have equal hashes wherever they lie."""
    if len(start) == 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum(_BYTE[buf] * _powers("up", len(buf)), out=total[1:])
    h = (total[end] - total[start]) * _powers("down", len(buf))[start]
    return mix(h + (end - start).astype(U64) * _ODD)


def words(texts: list, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order (A-Z lower-cased), and each text's first word, with the end last."""
    buf, starts = pack(texts)
    s, e = spans(buf, member)
    return hash_spans(buf, s, e), np.searchsorted(s, starts)


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (shorter by n - 1 than ``h``)."""
    if len(h) < n:
        return np.zeros(0, dtype=U64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out *= _BASE
        out += h[k : len(h) - n + 1 + k]
    return mix(out)


def batches(rows: Iterator[tuple[list, list]], limit: int = 4 << 20) -> Iterator[tuple[list, list]]:
    """Cut (keys, texts) into parts of about ``limit`` characters; a longer text is a part of its own."""
    for keys, texts in rows:
        lo, size = 0, 0
        for k, t in enumerate(texts):
            size += 0 if t is None else len(t)
            if size >= limit:
                yield keys[lo : k + 1], texts[lo : k + 1]
                lo, size = k + 1, 0
        if lo < len(texts):
            yield keys[lo:], texts[lo:]
