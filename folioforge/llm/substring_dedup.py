"""Suffix-array dedup: bytes that a string of ``LENGTH`` bytes covers which also starts in a document of a smaller id go.

1. Every string of LENGTH bytes (a window) has one anchor: the leftmost of its K-byte parts with the least hash.
   Equal windows have equal anchors at equal places, so only windows of one anchor need comparing. Anchors are counted
   by hash; those of two documents or more are kept as sorted hash arrays in the shared folder.
2. Each stretch of windows with one shared anchor gives a context (its bytes) and an occurrence (document and place).
   Equal contexts of a task are sent once, with their least document.
3. For each anchor, a suffix array of its different contexts (the anchor standing as one symbol) is built by
   linear grouping construction (``gsaca``). Windows that are equal are neighbours in it; each window gets the least
   document in which it starts. An anchor with one context needs no sorting: all its windows are equal. Of other contexts only the
   windows are sorted whose bytes before and after the anchor another context can have (``_meeting``).
4. Occurrences meet the results of their context; the byte ranges they lose meet the texts, which are cut.

Memory: a bucket is cut into sub-buckets of about ``SUB_SIZE`` contexts, as many as the counts of step 1 ask for, and a reduce
task decodes one of them at a time; what it holds of the others is compressed.

Skew: anchors of ``HOT_DOCS`` documents or more that would make more than 1 / ``HOT_PART`` of their bucket are not gathered: each of
their windows is a context of its own, dealt by its content. (A bound by documents alone makes more anchors hot as the corpus grows.) Contexts that one task sees often are spread over several buckets of step 4.

Defined cases: a null text is empty; a text under LENGTH bytes loses nothing; a null id is larger than every other; rows of one
id never cut each other; a very long text is read whole, in a batch of its own; of several documents that a string starts in
the least id keeps it; an empty table gives an empty table; extra columns are not returned.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow, _exchange, _store, _words
from folioforge.llm.gsaca import suffix_array

U64, U32, I64 = np.uint64, np.uint32, np.int64
LENGTH, K = 50, 26
HOT_DOCS, HOT_PART, WIDE, SALTS = 4096, 16, 64, 16
#: a flush makes a payload for each bucket: the more buckets, the smaller they get, so flushes are as large as memory allows
FLUSH_ANCHORS, FLUSH_BYTES, FLUSH_TEXT = 3_000_000, 32 << 20, 32 << 20
ROWS_BYTES = 1 << 20
BATCH, LEVEL = 1 << 20, 3
SA_SYMBOLS = 60_000
#: contexts of a sub-bucket, about; and the sub-buckets of a bucket of anchors while they are counted
SUB_SIZE, COUNT_SUBS = 600_000, 2
PLACE_BITS = 26
#: bits of an anchor's hash by which it is counted; a clash only makes an anchor a candidate that it need not be
COUNT_BITS = 48
_UPPER = U64(0xFFFFFFFFFFFFFFFF << PLACE_BITS & 0xFFFFFFFFFFFFFFFF)
_FACTORS = _words.mix(np.arange(11, 16, dtype=U64)) | U64(1)
NULL_ID = np.iinfo(np.int64).max


def stretches(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one anchor: first and last window, anchor's place and hash, and text number."""
    none = np.zeros(0, dtype=I64)
    if len(buf) < LENGTH:
        return none, none, none, np.zeros(0, dtype=U64), none
    # hash of K bytes from halves: a sum of the bytes' random numbers, each by its own odd factor
    part = _words._BYTE[buf]
    for step, factor in zip((1, 2, 4, 8, K - 16), _FACTORS, strict=True):
        left = part[:-step] * factor
        left += part[step:]
        part = left
    h = part
    h ^= h >> U64(32)
    h *= _words._M1
    h ^= h >> U64(29)
    # least hash of the window's parts, by its upper bits, the left one on ties
    have, need = 1, LENGTH - K + 1
    at = np.arange(len(h), dtype=U64)
    if len(h) < 1 << PLACE_BITS:  # bits and place in one number
        value = (h & _UPPER) | at
        while have < need:
            step = min(have, need - have)
            value = np.minimum(value[:-step], value[step:])
            have += step
        at = value & ~_UPPER
    else:
        value = h & _UPPER
        while have < need:
            step = min(have, need - have)
            less = value[step:] < value[:-step]
            value = np.where(less, value[step:], value[:-step])
            at = np.where(less, at[step:], at[:-step])
            have += step
    ends = starts[1:] - LENGTH  # the text's end is one before the next start
    real = np.flatnonzero(ends > starts[:-1])
    flag = np.zeros(len(at) + 1, dtype=np.int8)
    flag[starts[:-1][real]] += 1
    flag[ends[real]] -= 1
    window = np.flatnonzero(np.cumsum(flag[:-1], dtype=np.int8))
    if not len(window):
        return none, none, none, np.zeros(0, dtype=U64), none
    anchor = at[window].astype(I64)
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    lo, hi, place = window[first], window[last], anchor[first]
    # the least hashes are small numbers: mixed again, they spread over all buckets
    return lo, hi, place, _words.mix(h[place]), np.searchsorted(starts, lo, side="right") - 1


class Shared:
    """Sorted hashes of the anchors that several documents have, and which are hot, in files."""

    def __init__(self, folder: str, sizes: list[int], subs: int = 1):
        self.folder, self.sizes, self.subs, self._maps = folder, sizes, subs, {}

    def __getstate__(self):
        return self.__dict__ | {"_maps": {}}

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is shared, and hot."""
        distinct, back = np.unique(h >> U64(64 - COUNT_BITS) << U64(64 - COUNT_BITS), return_inverse=True)
        there, hot = np.zeros(len(distinct), dtype=bool), np.zeros(len(distinct), dtype=bool)
        places = _exchange.cut(distinct, len(self.sizes))
        for b, size in enumerate(self.sizes):
            lo, hi = places[b], places[b + 1]
            if lo == hi or not size:
                continue
            if b not in self._maps:
                self._maps[b] = (_store.mapped(f"{self.folder}/anchor-{b}", U64), _store.mapped(f"{self.folder}/hot-{b}", np.uint8))
            have, many = self._maps[b]
            p = np.minimum(np.searchsorted(have, distinct[lo:hi]), size - 1)
            there[lo:hi] = have[p] == distinct[lo:hi]
            hot[lo:hi] = there[lo:hi] & (many[p] > 0)
        return there[back], hot[back]


def _sum_sorted(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    at = _exchange.firsts(h)
    return h[at], (np.add.reduceat(c, at) if len(at) else c)


def shared_anchors(src: DataFrame, hot_docs: int = HOT_DOCS) -> Shared:
    spark = src.sparkSession
    n, folder = _exchange.buckets(spark), _store.shared_dir(spark)

    def count(it):
        held, size = [], 0

        def flush():
            h, c = _sum_sorted(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            c = np.minimum(c, 65535).astype(np.uint16)
            at = _exchange.cut(h << U64(64 - COUNT_BITS), n * COUNT_SUBS)
            yield from _sealed(at, n, COUNT_SUBS, lambda own: (_exchange.deltas(h[own]), c[own]))

        for _, texts in _exchange.in_batches(it, limit=BATCH):
            buf, starts = _words.pack(texts, lower=False)
            _, _, _, h, doc = stretches(buf, starts)
            h = h >> U64(64 - COUNT_BITS)
            order = np.argsort(h, kind="stable")
            h, doc = h[order], doc[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h = h[new]  # once for each document
            at = _exchange.firsts(h)
            held.append((h[at], np.diff(np.append(at, len(h))).astype(I64)))
            size += len(at)
            if size > FLUSH_ANCHORS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    kinds = pa.schema([("bucket", pa.int32()), ("size", pa.int64()), ("contexts", pa.int64()), ("spread", pa.int64())])

    def write(bucket, payloads):
        found = []
        for k in range(COUNT_SUBS):
            parts = list(_exchange.unseal(payloads, k))
            if parts:
                h, c = _sum_sorted(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]), np.concatenate([p[1].astype(I64) for p in parts]))
                found.append((h[c > 1] << U64(64 - COUNT_BITS), c[c > 1]))
        h, c = (np.concatenate([f[j] for f in found]) for j in range(2))
        hot = c >= max(hot_docs, int(c[c < hot_docs].sum()) // HOT_PART)
        _store.put(f"{folder}/anchor-{bucket}", h)
        _store.put(f"{folder}/hot-{bucket}", hot.astype(np.uint8))
        spread = int(c[hot].sum()) * (LENGTH - K + 1) // 2  # windows of a stretch, on average
        return pa.table({"bucket": [bucket], "size": [len(h)], "contexts": [int(c[~hot].sum())], "spread": [spread]}, schema=kinds)

    sizes, most, spread = [0] * n, 0, 0
    for r in _exchange.gather(_exchange.emit(src, count), "bucket int, size long, contexts long, spread long", write).collect():
        sizes[r["bucket"]] = r["size"]
        most, spread = max(most, r["contexts"]), spread + r["spread"]
    return Shared(folder, sizes, -(-(most + spread // n) // SUB_SIZE) or 1)


def _sealed(at, n: int, subs: int, arrays, first: int = 0, mark: bytes = b""):
    """Rows of the buckets, of values whose sub-bucket f of all n * subs starts at ``at[f]``; ``arrays(slice)`` is what is sent of it.
    Bucket numbers begin at ``first``, payloads with ``mark``. One batch holds the rows of many buckets."""
    pairs, size = [], 0
    for b in np.unique(np.flatnonzero(np.diff(at)) // subs).tolist():
        ends = at[b * subs : (b + 1) * subs + 1].tolist()
        parts = [_exchange.encode(*arrays(slice(lo, hi)), level=LEVEL) if lo < hi else b"" for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        pairs.append((first + b, mark + _exchange.seal(parts)))
        size += len(pairs[-1][1])
        if size >= ROWS_BYTES:
            yield _exchange.rows(pairs)
            pairs, size = [], 0
    if pairs:
        yield _exchange.rows(pairs)


def _slices(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places of all bytes of the ranges, one range after another."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _sides(buf: np.ndarray, lo: np.ndarray, left: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Bytes of contexts without their anchors: what is before and what is after."""
    start, size = np.stack([lo, lo + left + K], axis=1).ravel(), np.stack([left, length - left - K], axis=1).ravel()
    return buf[_slices(start, size)]


def _row_keys(ids: list, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers, and a key for each (id, text)."""
    id_ = np.array([NULL_ID if i is None else i for i in ids], dtype=I64)
    text = np.array([hash_bytes(t) for t in texts], dtype=U64)
    return id_, _words.mix(_words.mix(id_.view(U64)) ^ text)


def hash_bytes(t) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"" if t is None else t.encode("utf-8", "surrogatepass"))


def _contexts(src: DataFrame, shared: Shared) -> DataFrame:
    """Blocks: contexts for buckets 0 to n - 1, occurrences for n to 2 n - 1."""
    n, m = len(shared.sizes), shared.subs
    broadcast = src.sparkSession.sparkContext.broadcast(shared)

    def run(it):
        found = broadcast.value
        held, size = [], 0

        def flush():
            key, anchor, id_, row, lo, left, length, hot = (np.concatenate([x[k] for x in held]) for k in range(8))
            raw = np.concatenate([x[8] for x in held])
            order = np.argsort(key, kind="stable")
            heads = _exchange.firsts(key[order])
            runs = np.diff(np.append(heads, len(order)))
            least, most = np.minimum.reduceat(id_[order], heads), np.maximum.reduceat(id_[order], heads)
            wide = runs >= WIDE
            one = order[heads]
            offset = np.cumsum(length - K) - (length - K)
            to = _exchange.bucket_of(np.where(hot[one], key[one], anchor[one]), n * m).astype(I64)
            by = np.argsort(to, kind="stable")
            places = np.searchsorted(to[by], np.arange(n * m + 1))

            def contexts(own):
                own = by[own]
                c = one[own]
                return (
                    anchor[c], _exchange.deltas(key[c]), least[own], most[own] - least[own], left[c].astype(np.uint8),
                    length[c].astype(np.uint8), wide[own].astype(np.uint8), raw[_slices(offset[c], length[c] - K)],
                )

            yield from _sealed(places, n, m, contexts)
            # occurrences, those of wide contexts by document over several buckets
            spread = np.repeat(wide, runs)
            salt = np.where(spread, row[order] % U64(min(n, SALTS)), U64(0))
            to = _salted(key[order], salt, n, m)
            by_key = order[np.argsort(to, kind="stable")]
            places = np.searchsorted(np.sort(to, kind="stable"), np.arange(n * m + 1))

            def occurrences(own):
                own = by_key[own]
                rows, small = np.unique(row[own], return_inverse=True)
                ids = np.zeros(len(rows), dtype=I64)
                ids[small] = id_[own]
                return _exchange.deltas(key[own]), small.astype(U32), lo[own].astype(U32), rows, ids

            yield from _sealed(places, n, m, occurrences, n, b"o")

        for ids, texts in _exchange.in_batches(it, limit=BATCH):
            buf, starts = _words.pack(texts, lower=False)
            lo, hi, place, h, doc = stretches(buf, starts)
            there, hot = found.find(h)
            lo, hi, place, h, doc, hot = lo[there], hi[there], place[there], h[there], doc[there], hot[there]
            if hot.any():  # every window of a hot anchor is a context of its own
                times = np.where(hot, hi - lo + 1, 1)
                first = np.repeat(lo, times)
                first = first + np.where(np.repeat(hot, times), np.arange(len(first)) - np.repeat(np.cumsum(times) - times, times), 0)
                lo, hi = first, np.where(np.repeat(hot, times), first, np.repeat(hi, times))
                place, h, doc, hot = (np.repeat(x, times) for x in (place, h, doc, hot))
            if not len(lo):
                continue
            id_, row = _row_keys(ids, texts)
            left, length = place - lo, hi - lo + LENGTH
            key = _words.mix(_words.hash_spans(buf, lo, lo + length) + left.astype(U64) * _words._ODD + hot.astype(U64))
            held.append((key, h, id_[doc], row[doc], lo - starts[doc], left, length, hot, _sides(buf, lo, left, length)))
            size += int(length.sum())
            if size > FLUSH_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return _exchange.emit(src, run)


def _salted(key: np.ndarray, salt, n: int, m: int) -> np.ndarray:
    """Sub-buckets of keys, moved by the salt to other buckets."""
    return ((_exchange.bucket_of(key, n * m) + salt * U64(max(n // SALTS, 1) * m)) % U64(n * m)).astype(I64)


def least_starts(contexts: list[tuple[int, int, bytes, int]]) -> list[np.ndarray]:
    """For each context (anchor, left length, bytes around the anchor, least document): of each window, the least document it starts in.

    One suffix array of all contexts, whose anchors stand as one symbol each. A window is then
    LENGTH - K + 1 symbols, and equal windows are neighbours among the windows in suffix order.
    """
    symbols: list[int] = []
    numbers: dict[int, int] = {}
    base, count = [], []
    for anchor, left, raw, _ in contexts:
        base.append(len(symbols))
        count.append(len(raw) + K - LENGTH + 1)
        symbols.extend(raw[:left])
        symbols.append(256 + numbers.setdefault(anchor, len(numbers) + 1))
        symbols.extend(raw[left:])
        symbols.append(256)
    text = np.array(symbols, dtype=I64) + 1
    first, n = np.array(base, dtype=I64), np.array(count, dtype=I64)
    owner = np.full(len(text), -1, dtype=I64)
    owner[_slices(first, n)] = np.repeat(np.arange(len(contexts)), n)
    order = np.array(suffix_array(text.tolist()), dtype=I64)
    order = order[owner[order] >= 0]
    width = LENGTH - K + 1
    equal = np.ones(len(order) - 1, dtype=bool)
    for k in range(width):
        equal &= text[order[1:] + k] == text[order[:-1] + k]
    head = np.flatnonzero(np.append(True, ~equal))
    ids = np.array([c[3] for c in contexts], dtype=I64)[owner[order]]
    least = np.repeat(np.minimum.reduceat(ids, head), np.diff(np.append(head, len(order))))
    out = np.zeros(len(text), dtype=I64)
    out[order] = least
    return [out[b : b + c] for b, c in zip(base, count, strict=True)]


def _meeting(raw, offset, left, length, groups, some) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each context of ``some`` that can start in another context of its anchor (none if first > last).

    A window goes as far to the left and to the right of the anchor as its place says, and another context has it only if it has
    both sides; so the longest side that any other context shares bounds the windows that need sorting.
    """
    width = LENGTH - K
    low, high = np.zeros(len(left), dtype=I64), np.full(len(left), -1, dtype=I64)
    group = np.repeat(np.arange(len(groups) - 1), np.diff(groups))
    step = np.arange(width)
    for part in _whole(some, group) if len(some) else ():
        before, at = left[part].astype(I64), offset[part]
        after = length[part] - K - before
        shared = []
        for side, start, sign in ((before, at + before - 1, -1), (after, at + before, 1)):
            there = step < side[:, None]
            near = np.where(there, raw[np.where(there, start[:, None] + sign * step, 0)], 0).astype(np.uint8)
            order = np.lexsort((*near.view(">u8").T[::-1], group[part]))
            near, own = near[order], group[part][order]
            same = np.where(own[1:] == own[:-1], np.cumprod(near[1:] == near[:-1], axis=1, dtype=np.uint8).sum(1), 0)
            longest = np.empty(len(part), dtype=I64)
            longest[order] = np.maximum(np.append(0, same), np.append(same, 0))
            shared.append(np.minimum(longest, side))
        low[part] = np.maximum(before - shared[0], 0)
        high[part] = np.minimum(before - width + shared[1], length[part] - LENGTH)
    return low, high


def _whole(some: np.ndarray, group: np.ndarray, size: int = 50_000):
    """Parts of ``some`` of about ``size`` that cut no group."""
    ends = _exchange.firsts(group[some])
    ends = np.append(ends[np.append(True, ends[1:] // size != ends[:-1] // size)], len(some))
    return [some[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def _solve(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Results of the contexts of one sub-bucket: key, first and last window, least document, whether wide."""
    anchor, least, most, left, length, wide = (np.concatenate([p[k] for p in parts]) for k in (0, 2, 3, 4, 5, 6))
    key = np.concatenate([np.cumsum(p[1], dtype=U64) for p in parts])
    raw = np.concatenate([p[7] for p in parts])
    parts.clear()
    most += least
    length = length.astype(I64)
    offset = np.cumsum(length - K) - (length - K)
    order = np.lexsort((key, anchor))
    heads = _exchange.firsts(key[order])
    least, most = np.minimum.reduceat(least[order], heads), np.maximum.reduceat(most[order], heads)
    wide = np.maximum.reduceat(wide[order], heads)
    one = order[heads]
    anchor, key, left, length, offset = anchor[one], key[one], left[one], length[one], offset[one]
    groups = np.append(_exchange.firsts(anchor), len(anchor))
    single = np.zeros(len(anchor), dtype=bool)
    single[groups[:-1][np.diff(groups) == 1]] = True
    low, high = _meeting(raw, offset, left, length, groups, np.flatnonzero(~single))
    single |= low > high
    out = [np.stack([np.flatnonzero(single), 0 * length[single], length[single] - LENGTH, least[single]])]
    data = raw.tobytes()

    def solve(batch):
        own = np.array(batch, dtype=I64)
        lo, size = low[own], high[own] - low[own] + LENGTH
        begin = offset[own] + lo
        parts = zip(anchor[own].tolist(), (left[own] - lo).tolist(), begin.tolist(), (begin + size - K).tolist(), least[own].tolist(), strict=True)
        got = least_starts([(a, k, data[x:y], i) for a, k, x, y, i in parts])
        n = length[own] - LENGTH + 1
        values, which = np.repeat(least[own], n), np.repeat(np.arange(len(batch)), n)
        values[_slices(np.cumsum(n) - n + lo, size - LENGTH + 1)] = np.concatenate(got)
        place = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (which[1:] != which[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(values)) - 1
        out.append(np.stack([own[which[first]], place[first], place[last], values[first]]))

    rest = np.flatnonzero(~single)
    symbols = np.append(0, np.cumsum(high[rest] - low[rest] + LENGTH - K + 2))
    ends = np.searchsorted(rest, groups).tolist()
    batch, size = [], 0
    for lo, hi in zip(ends[:-1], ends[1:], strict=True):
        if hi > lo:
            batch.extend(rest[lo:hi].tolist())
            size += int(symbols[hi] - symbols[lo])
            if size > SA_SYMBOLS:
                solve(batch)
                batch, size = [], 0
    if batch:
        solve(batch)
    which, first, last, value = np.concatenate(out, axis=1)
    use = value < most[which]
    which, first, last, value = which[use], first[use], last[use], value[use]
    return key[which], first, last, value, wide[which] > 0


def _results(blocks: DataFrame, n: int, m: int) -> DataFrame:
    def run(bucket, payloads):
        if bucket >= n:
            return _table([_exchange.rows([(bucket, p) for p in payloads])])
        solved = [_solve(parts) for k in range(m) if (parts := list(_exchange.unseal(payloads, k)))]
        key, first, last, value, wide = (np.concatenate([r[j] for r in solved]) for j in range(5))
        salts = min(n, SALTS)
        which = np.concatenate([np.arange(len(key)), *(np.flatnonzero(wide) for _ in range(1, salts))])
        salt = np.concatenate([np.zeros(len(key), dtype=U64), *(np.full(int(wide.sum()), s, dtype=U64) for s in range(1, salts))])
        to = _salted(key[which], salt, n, m)
        by = np.argsort(to, kind="stable")
        which, places = which[by], np.searchsorted(to[by], np.arange(n * m + 1))

        def found(own):
            own = which[own]
            return key[own], first[own].astype(np.uint8), last[own].astype(np.uint8), value[own]

        return _table(_sealed(places, n, m, found, n, b"r"))

    return _exchange.gather(blocks, _exchange.BLOCK, run)


def _table(batches) -> pa.Table:
    return pa.Table.from_batches(batches, schema=_exchange.ARROW)


def _ranges(blocks: DataFrame, n: int, m: int) -> DataFrame:
    """Byte ranges to remove, by row, for buckets 0 to n - 1 of the row key."""

    def run(_, payloads):
        results, occurrences = [p for p in payloads if p[:1] == b"r"], [p for p in payloads if p[:1] == b"o"]
        if not results:
            return _table([])
        held = []
        for k in range(m):
            parts = list(_exchange.unseal(results, k, 1))
            if not parts:
                continue
            key, first, last, value = (np.concatenate([r[j] for r in parts]) for j in range(4))
            order = np.argsort(key, kind="stable")
            key, first, last, value = key[order], first[order].astype(I64), last[order].astype(I64), value[order]
            for okey, small, lo, rows, ids in _exchange.unseal(occurrences, k, 1):
                okey = np.cumsum(okey, dtype=U64)
                a, b = np.searchsorted(key, okey, side="left"), np.searchsorted(key, okey, side="right")
                who, at = np.repeat(np.arange(len(okey)), b - a), _slices(a, b - a)
                use = value[at] < ids[small[who]]
                who, at = who[use], at[use]
                row, start = rows[small[who]], lo[who].astype(I64) + first[at]
                held.append((row, start.astype(U32), (last[at] - first[at] + LENGTH).astype(U32)))
        if not held:
            return _table([])
        row, start, length = (np.concatenate([h[j] for h in held]) for j in range(3))
        held.clear()
        order = np.lexsort((start, row))
        row, start, length = row[order], start[order], length[order]
        return _table(_sealed(_exchange.cut(row, n * m), n, m, lambda own: (_exchange.deltas(row[own]), start[own], length[own]), 0, b"x"))

    return _exchange.gather(blocks, _exchange.BLOCK, run)


def _texts(src: DataFrame, n: int, m: int) -> DataFrame:
    """Blocks of whole texts by row key."""

    def run(it):
        held, size = [], 0

        def flush():
            id_, row = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            raw = [t for h in held for t in h[2]]
            order = np.argsort(row, kind="stable")

            def texts(own):
                own = order[own]
                data = b"".join(raw[k] for k in own)
                return row[own], id_[own], np.array([len(raw[k]) for k in own], dtype=I64), np.frombuffer(data, dtype=np.uint8)

            yield from _sealed(_exchange.cut(row[order], n * m), n, m, texts, 0, b"t")

        for ids, texts in _exchange.in_batches(it):
            id_, row = _row_keys(ids, texts)
            held.append((id_, row, [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]))
            size += sum(len(t) for t in held[-1][2])
            if size > FLUSH_TEXT:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return _exchange.emit(src, run)


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("kept", T.BinaryType()),
    ]
)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row for each document: its id, sizes, number of removed runs, digest of the kept bytes (and the bytes)."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shared = shared_anchors(src)
    n, m = len(shared.sizes), shared.subs
    ranges = _ranges(_results(_contexts(src, shared), n, m), n, m)
    blocks = _texts(src, n, m).unionByName(ranges)
    out = RESULT if with_kept else T.StructType(RESULT.fields[:-1])

    def run(_, payloads):
        cuts, texts = [p for p in payloads if p[:1] == b"x"], [p for p in payloads if p[:1] == b"t"]
        payloads.clear()
        for k in range(m):
            yield from _without(list(_exchange.unseal(cuts, k, 1)), _exchange.unseal(texts, k, 1), out)

    return _exchange.gather(blocks, out, run)


def _without(cuts: list, texts, out: T.StructType):
    """Result tables of texts (row keys, ids, lengths, bytes) without the cuts (row keys, starts, lengths) of their sub-bucket."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, with_kept = to_arrow_schema(out), "kept" in out.names
    row, start, end = np.zeros(0, dtype=U64), np.zeros(0, dtype=I64), np.zeros(0, dtype=I64)
    if cuts:
        row = np.concatenate([np.cumsum(c[0], dtype=U64) for c in cuts])
        start = np.concatenate([c[1] for c in cuts]).astype(I64)
        end = start + np.concatenate([c[2] for c in cuts])
        order = np.lexsort((start, row))
        row, start, end = row[order], start[order], end[order]
    for rows, ids, lens, data in texts:
        made: dict = {f.name: [] for f in out}
        offset, data = np.cumsum(lens) - lens, memoryview(data)
        a, b = np.searchsorted(row, rows, side="left"), np.searchsorted(row, rows, side="right")
        for k in range(len(rows)):
            raw = data[offset[k] : offset[k] + lens[k]]
            spans = _union(start[a[k] : b[k]], end[a[k] : b[k]])
            pieces, at = [], 0
            for s, e in spans:
                pieces.append(raw[at:s])
                at = e
            pieces.append(raw[at:])
            digest = hashlib.sha256()
            for x in pieces:
                digest.update(x)
            made["doc_id"].append(None if ids[k] == NULL_ID else int(ids[k]))
            made["n_bytes"].append(len(raw))
            made["n_removed"].append(sum(e - s for s, e in spans))
            made["n_spans"].append(len(spans))
            made["kept_sha256"].append(digest.hexdigest())
            if with_kept:
                made["kept"].append(b"".join(pieces))
        yield pa.table(made, schema=schema)


def _union(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of ranges sorted by start."""
    if not len(start):
        return []
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
    return list(zip(start[new].tolist(), reach[np.append(new[1:] - 1, len(reach) - 1)].tolist(), strict=True))


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(_arrow.documents(spark, sf_dir))


def brute_force(rows: list[tuple]) -> dict:
    """(n_bytes, n_removed, n_spans, digest) by a table of all windows; for tests."""
    least: dict[bytes, int] = {}
    data = [(i, (t or "").encode("utf-8", "surrogatepass")) for i, t in rows]
    for i, raw in data:
        for k in range(len(raw) - LENGTH + 1):
            w = raw[k : k + LENGTH]
            least[w] = min(least.get(w, i), i)
    out = {}
    for i, raw in data:
        gone = bytearray(len(raw))
        for k in range(len(raw) - LENGTH + 1):
            if least[raw[k : k + LENGTH]] < i:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
