"""Edit distances of many pairs of strings at once.

The bit-vector method of Myers (1999), in Hyyro's form with blocks of 64 rows: one column of the table is a few words, and
all pairs of a batch take their columns together in numpy. A column of a thousand pairs costs about as much as one cell of
the plain table does in the JVM for each of them, so whole texts can be compared.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: pairs that take their columns together, and bytes of their tables of letters
BATCH_PAIRS, TABLE_BYTES = 1024, 32 << 20


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both without their common beginning and end, which edits never touch."""
    n = min(len(a), len(b))
    lo, hi = 0, n
    if a[:16] != b[:16]:
        while lo < n and a[lo] == b[lo]:
            lo += 1
    else:
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    a, b, n = a[lo:], b[lo:], n - lo
    if not n or a[-1] != b[-1]:
        return a, b
    lo, hi = 1, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[-mid:] == b[-mid:] else (lo, mid - 1)
    return a[:-lo], b[:-lo]


def distance(a: str, b: str) -> int:
    """Of one pair; a column is a pair of long integers, which suits few pairs of long texts."""
    a, b = _trimmed(a, b)
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    mask, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = mask, 0, len(a)
    for c in b:
        match = at.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        rise, fall = down | ~(zero | up) & mask, zero & up
        score += bool(rise & top) - bool(fall & top)
        rise = rise << 1 | 1
        up, down = (fall << 1 | ~(zero | rise)) & mask, rise & zero & mask
    return score


def ned(a: str, b: str) -> float:
    return 0.0 if a == b else distance(a, b) / max(len(a), len(b))


def _codes(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _together(pairs: list[tuple[str, str]], words: int) -> np.ndarray:
    """Distances of pairs whose shorter side has at most 64 * ``words`` letters, in order of the longer side's length."""
    n = len(pairs)
    short, long = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    code = np.concatenate([_codes("".join(a for a, _ in pairs)), _codes("".join(b for _, b in pairs))])
    there = np.zeros(int(code.max()) + 1, dtype=np.int64)
    there[code] = 1
    number = np.cumsum(there) - 1
    code, size = number[code], int(number[-1]) + 1
    mine, theirs = code[: short.sum()], code[short.sum() :]
    # where[word, pair * size + letter]: rows of the word that hold the letter
    where = np.zeros((words, n * size), dtype=U64)
    place = np.arange(len(mine)) - np.repeat(np.cumsum(short) - short, short)
    np.add.at(where.reshape(-1), place // 64 * (n * size) + np.repeat(np.arange(n) * size, short) + mine, U64(1) << (place % 64).astype(U64))
    columns = np.zeros((int(long[-1]), n), dtype=np.int64)
    columns[np.arange(len(theirs)) - np.repeat(np.cumsum(long) - long, long), np.repeat(np.arange(n), long)] = theirs
    columns += np.arange(n) * size
    up, down = np.full((words, n), ~U64(0)), np.zeros((words, n), dtype=U64)
    last, bit = (short - 1) // 64, ((short - 1) % 64).astype(U64)
    ends_here = [last == w for w in range(words)]
    score, one, top = short.astype(np.int64), U64(1), U64(63)
    first = 0  # pairs before this one have had all their columns
    for j in range(len(columns)):
        while long[first] <= j:
            first += 1
        live = slice(first, n)
        rise_in, fall_in = np.ones(n - first, dtype=U64), np.zeros(n - first, dtype=U64)
        at = columns[j, live]
        for w in range(words):
            match = where[w].take(at)
            u, d = up[w, live], down[w, live]
            vertical = match | d
            match |= fall_in
            zero = match & u
            zero += u
            zero ^= u
            zero |= match
            fall = u & zero
            zero |= u
            rise = ~zero
            rise |= d
            if w == words - 1 or ends_here[w].any():
                own, b = ends_here[w][live], bit[live]
                score[live] += np.where(own, ((rise >> b) & one).astype(np.int64) - ((fall >> b) & one).astype(np.int64), 0)
            rise_out, fall_out = rise >> top, fall >> top
            rise <<= one
            rise |= rise_in
            fall <<= one
            fall |= fall_in
            np.bitwise_and(rise, vertical, out=down[w, live])
            vertical |= rise
            np.invert(vertical, out=vertical)
            np.bitwise_or(fall, vertical, out=up[w, live])
            rise_in, fall_in = rise_out, fall_out
    return score


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of the pairs a[k], b[k], in code points."""
    out = np.zeros(len(a), dtype=np.int64)
    known: dict[tuple[str, str], list[int]] = {}
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if x == y:
            continue
        x, y = _trimmed(x, y)
        if len(x) > len(y):
            x, y = y, x
        if not x:
            out[k] = len(y)
        else:
            known.setdefault((x, y), []).append(k)
    pairs = sorted(known, key=lambda p: ((len(p[0]) + 63) // 64, len(p[1])))
    lo = 0
    while lo < len(pairs):
        words, hi, columns = (len(pairs[lo][0]) + 63) // 64, lo + 1, len(pairs[lo][1])
        # pairs of about one size; their table of letters and their columns stay within TABLE_BYTES
        while hi < len(pairs) and hi - lo < BATCH_PAIRS and (len(pairs[hi][0]) + 63) // 64 == words and len(pairs[hi][1]) <= columns * 1.25 + 16:
            if (hi + 1 - lo) * (words * 96 + len(pairs[hi][1])) * 8 > TABLE_BYTES:
                break
            hi += 1
        batch = pairs[lo:hi]
        # microseconds of a column: twenty numpy calls a word, or a dozen operations on one long integer for each pair
        if words * 20 * (0.5 + len(batch) * 0.0006) < len(batch) * 12 * (0.06 + words * 0.001):
            got = _together(batch, words)
        else:
            got = [distance(x, y) for x, y in batch]
        for p, d in zip(batch, got, strict=True):
            out[known[p]] = d
        lo = hi
    return out
