"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

Words of the items become a generalised suffix automaton (one automaton of the suffixes of all items).
The words of every whole document are streamed through it while the length of the longest match that
ends at each word is tracked. A match of at least ``window`` words marks all its words; an item of fewer words
counts as one window and must match whole.

Speed: only words in runs whose neighbouring pairs all occur in some item can lie in a match of two words or
more, so vectorised lookups cut each document into such runs, and the automaton reads only
runs as long as the shortest window.

Memory: items are split into shards of at most ``shard_words`` words (a parameter), of which the driver builds one
automaton at a time. Built, an automaton is flat arrays (edges by state, links, lengths, owners) in files of the shared folder,
some 60 bytes a word, which workers memory-map; every batch of texts passes one shard after another, so no worker holds
more than pages of files and the marks of a batch, however many shards there are.

Defined cases: a null text or item has no words; items without words are no windows, nor are items with a null id; without
items nothing is hit; repeated item ids are one item with several texts; equal items all count; repeated rows are judged each;
very long texts are read whole, in a batch of their own; an empty table gives an empty table; extra columns stay, but for
those of the names that are made here, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow, _store, _words

WINDOW, SHARD_WORDS = 13, 600_000


class Automaton:
    """Generalised suffix automaton over sequences of word numbers, as it is built."""

    def __init__(self, seqs: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        for seq in seqs:
            last = 0
            for w in seq:
                last = self._extend(last, w)

    def _state(self, length: int, link: int, nxt: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(nxt)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of ``q`` for the matches that reach it through ``p``."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def arrays(self, seqs: list[list[int]], owner: list[int], window: int) -> dict[str, np.ndarray]:
        """The finished automaton in flat arrays.

        Edges of state s: ``word`` and ``to`` from ``first[s]`` on, by word. ``top``: the state of a match's last ``window`` words.
        ``own_first``, ``own``: the items in which a top state's window occurs. ``short_up``: the nearest state up the links at which
        items of fewer words end (``short_first``, ``short_size``, ``short``).
        """
        n = len(self.length)
        first = np.zeros(n + 1, dtype=np.int64)
        np.cumsum([len(x) for x in self.next], out=first[1:])
        edges = [e for x in self.next for e in sorted(x.items())]
        top, up = [-1] * n, [-1] * n
        pairs, short = set(), {}
        # splitting may have moved a prefix to another state: each item is read again on the finished automaton
        ends = []
        for seq in seqs:
            s, path = 0, []
            for w in seq:
                s = self.next[s][w]
                path.append(s)
            ends.append(path)
        for name, seq, path in zip(owner, seqs, ends, strict=True):
            if 0 < len(seq) < window:
                short.setdefault(path[-1], set()).add((len(seq), name))
        for s in sorted(range(1, n), key=self.length.__getitem__):
            above = self.link[s]
            if self.length[s] >= window:
                top[s] = s if self.length[above] < window else top[above]
            up[s] = s if s in short else up[above]
        for name, path in zip(owner, ends, strict=True):
            pairs.update((top[s], name) for s in path[window - 1 :])
        return {
            "first": first, "word": np.array([e[0] for e in edges], dtype=np.int32), "to": np.array([e[1] for e in edges], dtype=np.int32),
            "link": np.array(self.link, dtype=np.int32), "length": np.array(self.length, dtype=np.int32), "top": np.array(top, dtype=np.int32),
            "short_up": np.array(up, dtype=np.int32), **_listed("own", n, [(s, x) for s, x in pairs]),
            **_listed("short", n, [(s, x) for s, ends_ in short.items() for _, x in ends_]),
            "short_size": np.array([k for s in sorted(short) for k, _ in sorted(short[s], key=lambda e: e[1])], dtype=np.int32),
        }


def _listed(name: str, n: int, pairs: list[tuple[int, int]]) -> dict[str, np.ndarray]:
    """Items by state: where each state's begin, and the items."""
    pairs.sort()
    first = np.searchsorted(np.array([s for s, _ in pairs], dtype=np.int64), np.arange(n + 1))
    return {f"{name}_first": first, name: np.array([x for _, x in pairs], dtype=np.int32)}


KINDS = {
    "vocab": np.uint64, "pairs": np.int64, "names": np.uint8, "names_first": np.int64, "first": np.int64, "word": np.int32, "to": np.int32, "link": np.int32,
    "length": np.int32, "top": np.int32, "own_first": np.int64, "own": np.int32, "short_up": np.int32, "short_first": np.int64, "short": np.int32, "short_size": np.int32,
    "about": np.int64,
}


def build(items: list[tuple[str, str | None]], window: int = WINDOW) -> dict[str, np.ndarray]:
    """The arrays of a shard of items: vocabulary, pairs of neighbouring words, automaton, names."""
    hashes, first = _words.words([t for _, t in items], _words.ALNUM)
    vocab, ids = np.unique(hashes, return_inverse=True)
    seqs = [ids[first[k] : first[k + 1]].tolist() for k in range(len(items))]
    names = sorted({str(name) for name, _ in items})
    number = {name: k for k, name in enumerate(names)}
    size = np.int64(len(vocab) + 1)
    pairs = [ids[first[k] : first[k + 1] - 1] * size + ids[first[k] + 1 : first[k + 1]] for k in range(len(items))]
    raw = [x.encode("utf-8", "surrogatepass") for x in names]
    least = min((min(len(s), window) for s in seqs if s), default=0)
    return {
        "vocab": vocab, "pairs": np.unique(np.concatenate([p.astype(np.int64) for p in pairs])) if pairs else np.zeros(0, np.int64),
        "names": np.frombuffer(b"".join(raw), dtype=np.uint8), "names_first": np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64),
        "about": np.array([window, least], dtype=np.int64), **Automaton(seqs).arrays(seqs, [number[str(name)] for name, _ in items], window),
    }


class Matcher:
    """A shard of items, ready to mark the words of texts. ``read(name)`` gives one of its arrays."""

    def __init__(self, read):
        self.a = {name: read(name) for name in KINDS}
        self.window, self.least = (int(x) for x in self.a["about"])

    def scan(self, seq: list[int]):
        """Marked [start, end) ranges of ``seq`` and the numbers of the items that occur."""
        a, window = self.a, self.window
        first, word, to, link, length, top, up = (a[k] for k in ("first", "word", "to", "link", "length", "top", "short_up"))
        s = n = 0
        ranges, items, tops = [], set(), set()
        for k, w in enumerate(seq):
            while True:
                lo, hi = int(first[s]), int(first[s + 1])
                at = lo + int(np.searchsorted(word[lo:hi], w)) if hi - lo > 1 else lo
                if at < hi and word[at] == w:
                    s, n = int(to[at]), n + 1
                    break
                if not s:
                    n = 0
                    break
                s = int(link[s])
                n = int(length[s])
            if n >= window:
                tops.add(int(top[s]))
                ranges.append((k + 1 - n, k + 1))
            u = int(up[s])
            while u > 0:
                for x in range(int(a["short_first"][u]), int(a["short_first"][u + 1])):
                    size = int(a["short_size"][x])
                    if size <= n:
                        ranges.append((k + 1 - size, k + 1))
                        items.add(int(a["short"][x]))
                u = int(up[link[u]])
        for t in tops:
            items.update(a["own"][a["own_first"][t] : a["own_first"][t + 1]].tolist())
        return ranges, items

    def name(self, k: int) -> str:
        f = self.a["names_first"]
        return self.a["names"][f[k] : f[k + 1]].tobytes().decode("utf-8", "surrogatepass")

    def mark(self, h: np.ndarray, first: np.ndarray, out: list) -> None:
        """Add the marked word ranges and item ids of each text (words ``h``, those of text k from ``first[k]`` on)."""
        vocab, pairs = self.a["vocab"], self.a["pairs"]
        if not len(h) or not self.least:
            return
        at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
        known = vocab[at] == h
        # the word before goes on to this one, within a run
        on = np.zeros(len(h) + 1, dtype=bool)
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        if len(pairs) and len(both):
            code = at[both - 1].astype(np.int64) * np.int64(len(vocab) + 1) + at[both]
            p = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
            on[both[pairs[p] == code]] = True
        on[first] = False
        start = np.flatnonzero(~on)
        end = np.append(start[1:], len(h))[: len(start)]
        start, end = start[start < len(h)], end[start < len(h)]
        good = (end - start >= self.least) & known[start]
        doc = np.searchsorted(first, start[good], side="right") - 1
        for k, s, e in zip(doc.tolist(), start[good].tolist(), end[good].tolist(), strict=True):
            ranges, items = self.scan(at[s:e].tolist())
            if ranges:
                shift = s - int(first[k])
                out[k][0].extend((a + shift, b + shift) for a, b in ranges)
                out[k][1].update(map(self.name, items))


def mark(texts: list, matchers) -> list[tuple[int, list, set]]:
    """For each text: its number of words, marked word ranges and item ids, of one matcher after another."""
    h, first = _words.words(texts, _words.ALNUM)
    found = [([], set()) for _ in texts]
    for m in matchers:
        m.mark(h, first, found)
    return [(int(first[k + 1] - first[k]), ranges, items) for k, (ranges, items) in enumerate(found)]


def merged(ranges: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    buf, _ = _words.pack([text])
    s, e = _words.spans(buf, _words.ALNUM)
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at : s[a]])
        at = e[b - 1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


MARKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)


def shards(bench: DataFrame, id_col: str, text_col: str, shard_words: int) -> Iterator[list[tuple]]:
    """The items in lists of at most ``shard_words`` words each (one longer item is a list of its own), one list at a time."""
    held, size = [], 0
    for row in bench.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).toLocalIterator():
        if row.t is None or row.i is None:
            continue
        n = len(row.t) // 2 + 1  # words at most
        if held and size + n > shard_words:
            yield held
            held, size = [], 0
        held.append((row.i, row.t))
        size += n
    if held:
        yield held


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_percent: int = 5,
    max_span: int | None = None,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, hit_spans (word ranges), hit_items and contaminated.

    contaminated: some word is hit and the words hit are at least ``max_percent`` of all words, or a span is
    longer than ``max_span`` words. ``cut_contaminated`` then takes the spans out.
    """
    made = ["n_words", "n_hit", "n_items", "hit_spans", "hit_items", "contaminated"]
    out = docs.select(*[F.col(f"`{c}`") for c in _arrow.free_of(docs, made, keep=[text_col])])
    folder, n = _store.shared_dir(docs.sparkSession), 0
    for items in shards(bench, item_col, item_text_col, shard_words):
        for name, array in build(items, window).items():
            _store.put(f"{folder}/{n}-{name}", array.astype(KINDS[name], copy=False))
        n += 1

    def make():
        def matchers():
            for k in range(n):
                yield Matcher(lambda name: _store.mapped(f"{folder}/{k}-{name}", KINDS[name]))  # noqa: B023

        held = list(matchers()) if n == 1 else None

        def fn(texts):
            got = mark(texts, held or matchers())
            return {
                "n_words": [g[0] for g in got],
                "hit_spans": [[list(r) for r in merged(g[1])] for g in got],
                "hit_items": [sorted(g[2]) for g in got],
            }

        return fn

    out = _arrow.map_texts(out, text_col, MARKS, make, drop_text=False)
    total = F.aggregate("hit_spans", F.lit(0), lambda a, r: a + r[1] - r[0])
    out = out.withColumns({"n_hit": total.cast("long"), "n_items": F.size("hit_items").cast("long")})
    over = F.col("n_hit") * 100 >= F.col("n_words") * max_percent
    if max_span is not None:
        over = over | F.exists("hit_spans", lambda r: r[1] - r[0] > max_span)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & over)


def cut_contaminated(marked: DataFrame, text_col: str = "text") -> DataFrame:
    """The result of ``decontaminate`` with clean_text: the text without the hit spans of contaminated documents."""

    @F.pandas_udf(T.StringType())
    def cleaned(text, spans):
        import pandas as pd

        return pd.Series([None if t is None else cut(t, merged([tuple(r) for r in s])) for t, s in zip(text, spans, strict=True)])

    spans = F.when(F.col("contaminated"), F.col("hit_spans")).otherwise(F.array().cast("array<array<int>>"))
    return marked.withColumn("clean_text", cleaned(F.col(f"`{text_col}`"), spans))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = _arrow.documents(spark, sf_dir).select("doc_id", "text")
    got = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"), "contaminated"
    )


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> dict:
    """The contract's result by looking for every window at every place; for tests."""
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
    windows: dict = {}
    for name, text in items:
        w = word.findall(lower(text))
        for k in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[k : k + window]), set()).add(str(name))
    out = {}
    for name, text in docs:
        w = word.findall(lower(text))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[name] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out
