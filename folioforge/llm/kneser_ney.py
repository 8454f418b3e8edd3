"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted hash arrays.

1. Words of the training texts are counted by hash. Each bucket of the hash range writes its sorted hashes and
   counts as files of the shared folder; the rank of a hash is the word's number.
2. Bigrams are counted as pairs of numbers in the bucket of their first word. Each bucket writes its sorted pairs
   and counts, the statistics of its contexts (total, and numbers of pairs seen once, twice, more often),
   and passes on how many distinct first words each second word has.
3. Those continuation counts are summed by word.
4. Workers memory-map the arrays and score whole texts; sorted lookups read the files in order.

Skew: words that make up more than ``1 / HOT`` of the tokens (so at most HOT of them) have their pairs spread over all
buckets by the pair, and their statistics are summed afterwards. Map tasks add up equal words and
pairs before anything is shuffled.

Unknown words share one extra word's probability. The order is two: what a third one takes is in the README.

Defined cases: a null text is empty and consists of its end; a null id is not learned from and counts as held
out; repeated rows count each; a very long text is scored whole, in a batch of its own; words of one count and context are equal in
every sum, so ties need no order; extra columns stay, but for those of the names that are made here, which are replaced; without training rows every word is unknown and has probability 1; an empty table gives
an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow, _exchange, _store, _words

U64, U32 = np.uint64, np.uint32
END = U64(1)  # the hash of the end token
BEGIN, UNKNOWN = U64(0xFFFFFFFE), U64(0xFFFFFFFF)  # numbers of the start and of any unknown word
HOT = 1000
FLUSH = 3_000_000


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words followed by its end, and each text's first token, with the end last."""
    h, first = _words.words(texts, _words.NOT_SPACE)
    n = len(texts)
    out = np.empty(len(h) + n, dtype=U64)
    ends = first[1:] + np.arange(n)
    is_word = np.ones(len(out), dtype=bool)
    is_word[ends] = False
    out[is_word] = h
    out[ends] = END
    return out, first + np.arange(n + 1)


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    at = _exchange.firsts(keys)
    return keys[at], (np.add.reduceat(values, at) if len(at) else values)


class Vocabulary:
    """Sorted hashes and counts of the training words in files; numbers of hashes by search."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.sizes = folder, sizes
        self.offset = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        if self.offset[-1] > int(BEGIN):
            raise ValueError(f"{self.offset[-1]} distinct words: a word's number has 32 bits, two of which numbers are taken")
        self.with_pairs: set[int] = set()  # buckets to which some pair belongs
        self._maps: dict = {}

    def __getstate__(self):
        return self.__dict__ | {"_maps": {}}

    def array(self, name: str, bucket: int, dtype) -> np.ndarray:
        key = (name, bucket)
        if key not in self._maps:
            there = bucket in self.with_pairs if name in ("pair", "pairs", "big", "context") else self.sizes[bucket]
            self._maps[key] = _store.mapped(f"{self.folder}/{name}-{bucket}", dtype) if there else np.zeros(0, dtype)
        return self._maps[key]

    def numbers(self, sorted_hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct hashes, UNKNOWN for those that are not there."""
        out = np.full(len(sorted_hashes), UNKNOWN)
        places = _exchange.cut(sorted_hashes, len(self.sizes))
        for b in range(len(self.sizes)):
            lo, hi = places[b], places[b + 1]
            if lo == hi or not self.sizes[b]:
                continue
            have, want = self.array("word", b, U64), sorted_hashes[lo:hi]
            at = np.minimum(np.searchsorted(have, want), len(have) - 1)
            found = have[at] == want
            out[lo:hi][found] = (at[found] + self.offset[b]).astype(U64)
        return out

    def gather(self, name: str, dtype, numbers: np.ndarray) -> np.ndarray:
        """Values of sorted known numbers."""
        out = np.zeros(len(numbers), dtype=dtype)
        places = np.searchsorted(numbers, self.offset.astype(U64))
        for b in range(len(self.sizes)):
            lo, hi = places[b], places[b + 1]
            if lo < hi:
                out[lo:hi] = self.array(name, b, dtype)[(numbers[lo:hi] - U64(self.offset[b])).astype(np.int64)]
        return out

    def bucket(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, numbers.astype(np.int64), side="right") - 1


def numbered(vocabulary: Vocabulary, h: np.ndarray) -> np.ndarray:
    distinct, back = np.unique(h, return_inverse=True)
    return vocabulary.numbers(distinct)[back]


def _pair_bucket(vocabulary: Vocabulary, hot: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Bucket of a pair: that of its first word, or any one for the pairs of a hot first word."""
    u = pair >> U64(32)
    n = len(vocabulary.sizes)
    out = vocabulary.bucket(np.where(u == BEGIN, U64(0), u))
    spread = np.isin(u, hot)
    out[spread] = _exchange.bucket_of(_words.mix(pair[spread]), n).astype(np.int64)
    return out


class Model:
    """What a worker needs to score: files, discounts and the statistics of hot contexts."""

    def __init__(self, vocabulary, hot, hot_stats, uni, bi, total_tokens):
        self.vocabulary, self.hot, self.hot_stats = vocabulary, hot, hot_stats
        self.n, self.v = total_tokens, int(vocabulary.offset[-1])
        self.uni, self.bi = uni, bi
        self.d1, self.d2 = discounts(uni), discounts(bi)
        self.types = max(int(uni[-1]), 1)
        self.gamma0 = (self.d1[1] * uni[0] + self.d1[2] * uni[1] + self.d1[3] * uni[4]) / self.types if uni[-1] else 1.0

    def unigram(self, cont: np.ndarray) -> np.ndarray:
        """Probability of words by continuation count; 0 for unknown words."""
        c = np.minimum(cont, 3)
        return np.maximum(cont - self.d1[c], 0.0) / self.types + self.gamma0 / (self.v + 1)

    def score(self, texts: list) -> dict:
        h, first = tokens(texts)
        voc = self.vocabulary
        distinct, back = np.unique(h, return_inverse=True)
        number = voc.numbers(distinct)
        known = number != UNKNOWN
        count, cont = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        count[known] = voc.gather("count", U64, number[known])
        cont[known] = voc.gather("cont", U64, number[known])
        base = np.log10((count + 0.5) / (self.n + 0.5 * (self.v + 1)))
        p1 = self.unigram(cont)
        total, gamma = np.zeros(len(distinct)), np.ones(len(distinct))
        self._contexts(number, total, gamma)
        # pairs
        w = number[back]
        u = np.empty(len(h), dtype=np.int64)  # place of the word before among the distinct ones, -1: the start
        u[1:] = back[:-1]
        u[first[:-1]] = -1
        begin_total, begin_gamma = self._context_of(self.hot_stats.get(int(BEGIN)))
        before = np.where(u < 0, BEGIN, number[u])
        t, g = np.where(u < 0, begin_total, total[u]), np.where(u < 0, begin_gamma, gamma[u])
        sure = (w != UNKNOWN) & (before != UNKNOWN)
        c = np.zeros(len(h), dtype=np.int64)
        c[sure] = self._pairs((before[sure] << U64(32)) | w[sure])
        p = np.where(t > 0, np.maximum(c - self.d2[np.minimum(c, 3)], 0.0) / np.maximum(t, 1), 0.0) + g * p1[back]
        sums = lambda x: np.add.reduceat(x, first[:-1]) if len(x) else np.zeros(0)
        return {
            "n_tokens": np.diff(first),
            "n_known": sums(known[back].astype(np.int64)),
            "base_score": sums(base[back]),
            "score": sums(np.log10(p)),
        }

    def _context_of(self, stats):
        if stats is None or not stats[0]:
            return 0.0, 1.0
        return float(stats[0]), float(self.d2[1] * stats[1] + self.d2[2] * stats[2] + self.d2[3] * stats[3]) / stats[0]

    def _contexts(self, number, total, gamma):
        voc = self.vocabulary
        order = np.flatnonzero(number != UNKNOWN)
        known = number[order]  # sorted, as numbers are ranks of the sorted hashes
        places = np.searchsorted(known, voc.offset.astype(U64))
        for b in range(len(voc.sizes)):
            lo, hi = places[b], places[b + 1]
            if lo == hi:
                continue
            stats = voc.array("context", b, U64).reshape(-1, 4)
            if not len(stats):
                continue
            stats = stats[(known[lo:hi] - U64(voc.offset[b])).astype(np.int64)].astype(np.float64)
            at = order[lo:hi]
            total[at] = stats[:, 0]
            gamma[at] = np.where(stats[:, 0] > 0, (stats[:, 1:] @ self.d2[1:]) / np.maximum(stats[:, 0], 1), 1.0)
        for k in np.flatnonzero(np.isin(number, self.hot)):
            total[k], gamma[k] = self._context_of(self.hot_stats.get(int(number[k])))

    def _pairs(self, pair):
        distinct, back = np.unique(pair, return_inverse=True)
        bucket = _pair_bucket(self.vocabulary, self.hot, distinct)
        order = np.argsort(bucket, kind="stable")
        places = np.searchsorted(bucket[order], np.arange(len(self.vocabulary.sizes) + 1))
        out = np.zeros(len(distinct), dtype=np.int64)
        for b in range(len(self.vocabulary.sizes)):
            own = order[places[b] : places[b + 1]]
            if not len(own):
                continue
            have = self.vocabulary.array("pair", b, U64)
            if not len(have):
                continue
            want = distinct[own]
            at = np.minimum(np.searchsorted(have, want), len(have) - 1)
            found = have[at] == want
            counts = self.vocabulary.array("pairs", b, np.uint8)[at[found]].astype(np.int64)
            if (counts == 255).any():  # larger counts are in a list of their own
                big = self.vocabulary.array("big", b, U64).reshape(-1, 2)
                over = np.flatnonzero(counts == 255)
                counts[over] = big[np.searchsorted(big[:, 0], want[found][over]), 1].astype(np.int64)
            out[own[found]] = counts
        return out[back]


def discounts(n: np.ndarray) -> np.ndarray:
    """D(0) to D(3+) of modified Kneser-Ney from the numbers of types seen 1 to 4 times; halves where those are too few."""
    n1, n2, n3, n4 = (float(x) for x in n[:4])
    plain = np.array([0.0, 0.5, 0.75, 1.0])
    if not (n1 and n2 and n3 and n4):
        return plain
    y = n1 / (n1 + 2 * n2)
    got = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    bound = np.array([0.0, 1.0, 2.0, 3.0])
    return np.where((got > 0) & (got < bound) | (bound == 0), got, plain)


def _of_counts(c: np.ndarray) -> np.ndarray:
    """Numbers of types seen 1, 2, 3, 4 and 3 or more times, and the sum of counts."""
    few = np.bincount(np.minimum(c, 5).astype(np.int64), minlength=6)
    return np.array([few[1], few[2], few[3], few[4], few[3] + few[4] + few[5], int(c.sum())], dtype=np.int64)


def fit(train: DataFrame, id_col: str, text_col: str) -> Model:
    """Count the model of the texts of ``train`` into files of the shared folder."""
    spark = train.sparkSession
    n, folder = _exchange.buckets(spark), _store.shared_dir(spark)
    src = train.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def count_words(it):
        held, size = [], 0

        def flush():
            keys, counts = _sum_by(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            at = _exchange.cut(keys, n)
            for b in range(n):
                if at[b] < at[b + 1]:
                    own = slice(at[b], at[b + 1])
                    yield _exchange.rows([(b, _exchange.encode(_exchange.deltas(keys[own]), counts[own].astype(U64)))])

        for _, texts in _exchange.in_batches(it):
            h, _ = tokens(texts)
            held.append(np.unique(h, return_counts=True))
            size += len(held[-1][0])
            if size > FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def write_words(bucket, payloads):
        parts = [_exchange.decode(p) for p in payloads]
        keys, counts = _sum_by(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]), np.concatenate([p[1].astype(np.int64) for p in parts]))
        _store.put(f"{folder}/word-{bucket}", keys)
        _store.put(f"{folder}/count-{bucket}", counts.astype(U64))
        total = int(counts.sum())
        top = np.argsort(-counts, kind="stable")[:HOT]
        # at most HOT words of a bucket can be hot, whatever the other buckets hold; few are, so few are sent
        top = top[counts[top] * HOT >= total]
        return pa.table(
            {"bucket": [bucket], "size": [len(keys)], "total": [total], "top": [top.tolist()], "tops": [counts[top].tolist()]},
            schema=pa.schema([("bucket", pa.int32()), ("size", pa.int64()), ("total", pa.int64()), ("top", pa.list_(pa.int64())), ("tops", pa.list_(pa.int64()))]),
        )

    words = _exchange.gather(
        _exchange.emit(src, count_words), "bucket int, size long, total long, top array<long>, tops array<long>", write_words
    ).collect()
    sizes, total = [0] * n, sum(r["total"] for r in words)
    for r in words:
        sizes[r["bucket"]] = r["size"]
    vocabulary = Vocabulary(folder, sizes)
    hot = np.array(
        sorted([int(vocabulary.offset[r["bucket"]]) + k for r in words for k, c in zip(r["top"], r["tops"], strict=True) if c * HOT >= total] + [int(BEGIN)]),
        dtype=U64,
    )

    def count_pairs(it):
        held, size = [], 0

        def flush():
            pairs, counts = _sum_by(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            bucket = _pair_bucket(vocabulary, hot, pairs)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(n + 1))
            for b in range(n):
                if at[b] < at[b + 1]:
                    own = pairs[order[at[b] : at[b + 1]]]
                    c = counts[order[at[b] : at[b + 1]]]
                    first, second = (own >> U64(32)).astype(U32), own.astype(U32)
                    yield _exchange.rows([(b, _exchange.encode(_exchange.deltas(first), second, c.astype(U64)))])

        for _, texts in _exchange.in_batches(it):
            h, first = tokens(texts)
            w = numbered(vocabulary, h)
            before = np.empty_like(w)
            before[1:] = w[:-1]
            before[first[:-1]] = BEGIN
            held.append(np.unique((before << U64(32)) | w, return_counts=True))
            size += len(held[-1][0])
            if size > FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def write_pairs(bucket, payloads):
        parts = [_exchange.decode(p) for p in payloads]
        pairs = np.concatenate([(np.cumsum(p[0], dtype=U32).astype(U64) << U64(32)) | p[1].astype(U64) for p in parts])
        pairs, counts = _sum_by(pairs, np.concatenate([p[2].astype(np.int64) for p in parts]))
        _store.put(f"{folder}/pair-{bucket}", pairs)
        _store.put(f"{folder}/pairs-{bucket}", np.minimum(counts, 255).astype(np.uint8))
        big = np.flatnonzero(counts >= 255)
        _store.put(f"{folder}/big-{bucket}", np.stack([pairs[big], counts[big].astype(U64)], axis=1))
        u = pairs >> U64(32)
        at = _exchange.firsts(u)
        few = np.minimum(counts, 3)
        stats = np.stack([np.add.reduceat(x, at) for x in (counts, few == 1, few == 2, few == 3)], axis=1).astype(np.int64)
        heads = u[at]
        spread = np.isin(heads, hot)
        context = np.zeros((sizes[bucket], 4), dtype=U64)
        own = ~spread
        context[(heads[own] - U64(vocabulary.offset[bucket])).astype(np.int64)] = stats[own]
        _store.put(f"{folder}/context-{bucket}", context)
        second, preds = np.unique(pairs & U64(0xFFFFFFFF), return_counts=True)
        to = vocabulary.bucket(second)
        places = np.searchsorted(to, np.arange(n + 1))
        out = [
            (b, _exchange.encode(_exchange.deltas(second[places[b] : places[b + 1]].astype(U32)), preds[places[b] : places[b + 1]].astype(U64)))
            for b in range(n)
            if places[b] < places[b + 1]
        ]
        k = len(out)
        hot_rows = [np.concatenate(([int(x)], s)) for x, s in zip(heads[spread], stats[spread], strict=True)]
        return pa.table(
            {
                "bucket": [b for b, _ in out] + [-1],
                "payload": [p for _, p in out] + [None],
                "of_counts": [None] * k + [[*_of_counts(counts).tolist(), bucket]],
                "hot": [None] * k + [np.concatenate(hot_rows).tolist() if hot_rows else []],
            },
            schema=pa.schema([("bucket", pa.int32()), ("payload", pa.binary()), ("of_counts", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64()))]),
        )

    pairs = _store.written(
        _exchange.gather(_exchange.emit(src, count_pairs), "bucket int, payload binary, of_counts array<long>, hot array<long>", write_pairs),
        folder, "continuations",
    )
    bi, hot_stats = np.zeros(6, dtype=np.int64), {}
    for r in pairs.where("bucket < 0").select("of_counts").collect():
        *counts, source = r["of_counts"]
        bi += np.array(counts, dtype=np.int64)
        vocabulary.with_pairs.add(source)
    # the statistics of a hot word's pairs lie in many buckets; their sums are at most HOT + 1 rows
    fives = F.transform(F.sequence(F.lit(0), F.size("hot") - 5, F.lit(5)), lambda k: F.slice("hot", k + 1, 5))
    each = pairs.where((F.col("bucket") < 0) & (F.size("hot") > 0)).select(F.explode(fives).alias("h"))
    for r in each.groupBy(F.col("h")[0].alias("word")).agg(*[F.sum(F.col("h")[k]) for k in range(1, 5)]).collect():
        hot_stats[r["word"]] = np.array(r[1:], dtype=np.int64)

    def write_continuations(bucket, payloads):
        cont = np.zeros(sizes[bucket], dtype=np.int64)
        for p in payloads:
            second, preds = _exchange.decode(p)
            cont[(np.cumsum(second, dtype=U32).astype(np.int64) - vocabulary.offset[bucket])] += preds.astype(np.int64)
        _store.put(f"{folder}/cont-{bucket}", cont.astype(U64))
        return pa.table({"of_counts": [_of_counts(cont).tolist()]}, schema=pa.schema([("of_counts", pa.list_(pa.int64()))]))

    uni = np.zeros(6, dtype=np.int64)
    for r in _exchange.gather(pairs.where("bucket >= 0").select("bucket", "payload"), "of_counts array<long>", write_continuations).collect():
        uni += np.array(r["of_counts"], dtype=np.int64)
    return Model(vocabulary, hot, hot_stats, uni, bi, total)


SCORES = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def lm_scores(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score, score (log10 probability) and perplexity."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*[F.col(f"`{c}`") for c in _arrow.free_of(docs, ["train_tokens", "perplexity"], keep=[text_col])])
    got = _arrow.map_texts(src, text_col, SCORES, lambda: shared.value.score, drop_text)
    return got.withColumns(
        {"train_tokens": F.lit(model.n).cast("long"), "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))}
    )


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 1, F.lit(True))


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = _arrow.documents(spark, sf_dir).select("doc_id", "text")
    model = fit(docs.where(~held_out("doc_id")), "doc_id", "text")
    got = lm_scores(docs, model, drop_text=True)
    return got.select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
