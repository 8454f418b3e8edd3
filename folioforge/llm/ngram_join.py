"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct five-word shingles. All shingles have one global order: shingles of few
documents first. Steps:

1. Equal sets are one class (a 64-bit digest of the set); all that follows works on classes. A second digest, of other bits, is
   compared within each class; should two sets ever share the first one, all is done again with another seed.
2. Shingle hashes are exchanged by hash; each bucket keeps the shingles of two classes or more, with the number
   of classes. A class's other shingles count only for its size. Shingles that one map task
   finds in ``HOT`` or more classes are added up there and kept at once, so a passage that a third of all
   documents share reaches no single task.
3. In the global order a class's own shingles come first. Two classes that link share a shingle of their prefixes (the
   first n - ceil(t n) + 1 shingles). Classes whose prefix holds own shingles only have no partner and go.
4. The classes that share a prefix shingle form a bucket. Round one pairs each member with the bucket's hub (its
   least member), which is linear; the global order is cut into fragments (at the numbers of classes
   ``CUTS``, by which it is ordered first), each fragment counts the overlap of its part of a pair's sets, and the parts are
   summed for each pair (a join and a sum).
5. Components of the links so far; further rounds pair more hubs of a bucket with the members that are still in other
   components and that bounds leave possible (sizes, own shingles, bitmaps of the sets), and the last round pairs every member so.
   So a group of copies is not expanded into all its pairs, and every link between different components is found.

Defined cases: null, empty and blank texts have an empty set and link with nothing; texts of fewer words are one
shingle; the least id among copies names a class; a null id is never the least id, so it is its own (null) component only
where no other id is reached; repeated rows are copies; a very long text is one set, whole; of equal ones the least id and class
count, in every choice of hubs and prefixes; extra columns stay, but for those of the names that are made here, which are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm import _arrow, _exchange, _store, _words
from folioforge.llm.components import components

U64, U32, I64 = np.uint64, np.uint32, np.int64
SIZE, PERCENT, HOT = 5, 75, 64
#: where the global order is cut: a fragment holds the shingles of up to so many classes that the one before does not
CUTS = (2, 4, 16)
#: members of a bucket that are compared with the rest of it, in rounds after the first; None: every member
HUBS = (8, None)
#: members of a bucket's main component, and as many others, that one group of round two and later takes
SPLIT = 2048
#: bits of the bitmap by which pairs are ruled out
BITS = 2048
FLUSH = 1_200_000


def shingles(texts: list, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, first = _words.words(texts, _words.NOT_SPACE)
    g = _words.ngrams(h, size)
    out = []
    for k in range(len(texts)):
        lo, hi = int(first[k]), int(first[k + 1])
        if hi - lo >= size:
            out.append(np.unique(g[lo : hi - size + 1]))
        elif hi > lo:
            out.append(_words.ngrams(h[lo:hi], hi - lo) + U64(hi - lo))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def digest(s: np.ndarray, seed: int = 0) -> int:
    """Signed 64-bit digest of a set of hashes, 0 for the empty set."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        x = _words.mix(s + U64(seed) * _words._ODD)
        d = _words.mix(np.array([x.sum() ^ (U64(len(s)) * _words._ODD)], dtype=U64))[0] ^ np.bitwise_xor.reduce(_words.mix(x + U64(7)))
    return int(np.array([d], dtype=U64).view(I64)[0]) or 1


#: seed of the second digest
OTHER = 1 << 32
MEMBER = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("cls", T.LongType()), T.StructField("cls_check", T.LongType())])


def members(docs: DataFrame, text_col: str, size: int = SIZE, drop_text: bool = True, seed: int = 0) -> DataFrame:
    """``docs`` with n_shingles, the class of its set and the digest that checks it."""

    def make():
        def fn(texts):
            sets = shingles(texts, size)
            return {"n_shingles": [len(s) for s in sets], "cls": [digest(s, seed) for s in sets], "cls_check": [digest(s, OTHER) for s in sets]}

        return fn

    return _arrow.map_texts(docs, text_col, MEMBER, make, drop_text)


def _shared(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """(bucket, payload) by class: the shared shingles of each class with the number of classes that hold them."""
    n = _exchange.buckets(docs.sparkSession)

    def by_hash(it):
        held, seen, total = [], set(), 0

        def flush():
            cls = np.array([c for c, _ in held], dtype=I64)
            lens = [len(s) for _, s in held]
            h, who = np.concatenate([s for _, s in held]), np.repeat(np.arange(len(held), dtype=U32), lens)
            order = np.argsort(h, kind="stable")
            h, who = h[order], who[order]
            at = _exchange.firsts(h)
            runs = np.diff(np.append(at, len(h)))
            hot = np.repeat(runs >= HOT, runs)
            # hot here: the classes keep it at once; its bucket learns of it by one entry
            places = _exchange.cut(h[~hot], n)
            heads = _exchange.cut(h[at][runs >= HOT], n)
            cold_h, cold_w, hot_h = h[~hot], who[~hot], h[at][runs >= HOT]
            out = []
            for b in range(n):
                own, ho = slice(places[b], places[b + 1]), slice(heads[b], heads[b + 1])
                if places[b] < places[b + 1] or heads[b] < heads[b + 1]:
                    small = np.unique(cold_w[own], return_inverse=True)
                    out.append((b, b"h" + _exchange.encode(_exchange.deltas(cold_h[own]), small[1].astype(U32), cls[small[0]], _exchange.deltas(hot_h[ho]))))
            direct, dw = h[hot], who[hot]
            if len(direct):
                to = _exchange.bucket_of(cls.view(U64)[dw], n).astype(I64)
                o = np.argsort(to, kind="stable")
                pl = np.searchsorted(to[o], np.arange(n + 1))
                for b in range(n):
                    if pl[b] < pl[b + 1]:
                        own = o[pl[b] : pl[b + 1]]
                        out.append((n + b, b"d" + _exchange.encode(cls[dw[own]], direct[own], np.full(len(own), 0xFFFFFFFF, dtype=U32))))
            # every class's size, for its own bucket
            to = _exchange.bucket_of(cls.view(U64), n).astype(I64)
            for b in np.unique(to):
                own = np.flatnonzero(to == b)
                out.append((n + int(b), b"n" + _exchange.encode(cls[own], np.array(lens, dtype=I64)[own])))
            for k in range(0, len(out), 64):
                yield _exchange.rows(out[k : k + 64])

        for _, texts in _exchange.in_batches(it, limit=1 << 20):
            for s in shingles(texts, size):
                if len(s) and (d := digest(s, seed)) not in seen:
                    seen.add(d)
                    held.append((d, s))
                    total += len(s)
            if total > FLUSH:
                yield from flush()
                held, total = [], 0
                seen.clear()
        if held:
            yield from flush()

    blocks = _exchange.emit(docs, by_hash)

    def by_class(bucket, payloads):
        if bucket >= n:  # already by class
            return _block_table([(bucket - n, p) for p in payloads])
        parts = [_exchange.decode(p[1:]) for p in payloads]
        h = np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts])
        cls = np.concatenate([p[2][p[1]] for p in parts])
        hot = np.unique(np.concatenate([np.cumsum(p[3], dtype=U64) for p in parts]))
        # one class may come from several tasks
        order = np.lexsort((cls, h))
        h, cls = h[order], cls[order]
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (cls[1:] != cls[:-1])
        h, cls = h[keep], cls[keep]
        at = _exchange.firsts(h)
        runs = np.diff(np.append(at, len(h)))
        df = np.repeat(np.minimum(runs, 0xFFFFFFFE), runs).astype(U32)
        if len(hot) and len(h):
            p = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
            df[hot[p] == h] = 0xFFFFFFFF
        keep = df > 1
        h, cls, df = h[keep], cls[keep], df[keep]
        to = _exchange.bucket_of(cls.view(U64), n).astype(I64)
        order = np.argsort(to, kind="stable")
        places = np.searchsorted(to[order], np.arange(n + 1))
        out = []
        for b in range(n):
            own = order[places[b] : places[b + 1]]
            if len(own):
                out.append((b, b"d" + _exchange.encode(cls[own], h[own], df[own])))
        return _block_table(out)

    return _exchange.gather(blocks, _exchange.BLOCK, by_class)


def _block_table(pairs) -> pa.Table:
    return pa.Table.from_batches([_exchange.rows(pairs)], schema=_exchange.ARROW)


#: a surviving class: its size, its number of shared shingles, those in its prefix, all in fragments, and their bitmap
SURVIVOR = "cls long, n long, shared long, prefix array<long>, parts array<array<long>>, bits binary"


def bitmap(s: np.ndarray) -> bytes:
    """Parities of the numbers of hashes in BITS slots: two sets differ by as many hashes as their bitmaps by bits, or more."""
    slot = (_words.mix(s) >> U64(16)).astype(I64) % BITS
    return np.packbits((np.bincount(slot, minlength=BITS) & 1).astype(np.uint8)).tobytes()


def _survivors(shared: DataFrame, percent: int) -> DataFrame:
    kinds = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("prefix", pa.list_(pa.int64())), ("parts", pa.list_(pa.list_(pa.int64()))), ("bits", pa.binary())])

    def classes(_, payloads):
        sizes = [_exchange.decode(p[1:]) for p in payloads if p[:1] == b"n"]
        entries = [_exchange.decode(p[1:]) for p in payloads if p[:1] == b"d"]
        rows: dict = {k: [] for k in kinds.names}
        if not entries or not sizes:
            return pa.table(rows, schema=kinds)
        size_of = dict(zip(np.concatenate([s[0] for s in sizes]).tolist(), np.concatenate([s[1] for s in sizes]).tolist(), strict=True))
        cls, h, df = (np.concatenate([e[k] for e in entries]) for k in range(3))
        order = np.lexsort((h, df, cls))
        cls, h, df = cls[order], h[order], df[order]
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (cls[1:] != cls[:-1]) | (h[1:] != h[:-1])  # tasks that held copies of one class each sent hot shingles
        cls, h = cls[keep], h[keep]
        fragment = np.searchsorted(np.array(CUTS), df[keep])
        at = np.append(_exchange.firsts(cls), len(cls))
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            c, n, own = int(cls[lo]), size_of[int(cls[lo])], hi - lo
            take = n - -(-n * percent // 100) + 1 - (n - own)  # of the prefix, what is not the class's own shingles
            if take <= 0 or own * 100 < percent * n:
                continue
            s = h[lo:hi]
            part = fragment[lo:hi]
            rows["cls"].append(c)
            rows["n"].append(n)
            rows["shared"].append(own)
            rows["prefix"].append(s[:take].view(I64))
            rows["bits"].append(bitmap(s))
            rows["parts"].append([np.sort(s[part == f].view(I64)) for f in range(len(CUTS) + 1)])
        return pa.table(rows, schema=kinds)

    return _exchange.gather(shared, SURVIVOR, classes)


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, b): overlaps counted fragment by fragment, then summed for each pair."""
    part = sets.select("cls", "n", F.posexplode("parts").alias("f", "part"))
    right = pairs.join(part.withColumnsRenamed({"cls": "b", "n": "nb", "part": "pb"}), "b")
    both = right.join(part.withColumnsRenamed({"cls": "a", "n": "na", "part": "pa"}), ["a", "f"])
    counted = both.select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).cast("long").alias("k"))
    total = counted.groupBy("a", "b", "na", "nb").agg(F.sum("k").alias("k"))
    return total.where(F.col("k") * 100 >= (F.col("na") + F.col("nb") - F.col("k")) * percent).select("a", "b")


def _hub_pairs(sets: DataFrame) -> DataFrame:
    """Each member of a prefix bucket with the bucket's hub: the member with the least share of shingles of its own.

    Where a bucket holds variants of one text, that is the variant nearest to their common origin, with which
    most of the others link.
    """
    entry = sets.select(F.explode("prefix").alias("h"), "cls", "n", "shared")
    central = F.struct((F.lit(1.0) - F.col("shared") / F.col("n")).alias("own"), "cls", "n")
    # partial minima first; the join back is split by adaptive execution where one shingle is hot
    hub = entry.groupBy("h").agg(F.min(central).alias("hub"), F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high")
    hub = hub.select(F.col("h").bitwiseXOR(F.lit(0)).alias("hh"), F.col("hub.cls").alias("a"), F.col("hub.n").alias("na"))
    return entry.join(hub, F.col("h") == F.col("hh")).where("cls <> a").select("a", F.col("cls").alias("b"), "na", F.col("n").alias("nb"))


def _cross_pairs(sets: DataFrame, comp: DataFrame, percent: int, hubs: int | None = None) -> DataFrame:
    """Pairs of one prefix bucket in different components that the bounds leave possible, each once.

    With ``hubs`` only the pairs of that many most central members of each bucket, which is linear in its size.
    """
    n = 8 * _exchange.buckets(sets.sparkSession)  # many small groups deal out more evenly
    labelled = sets.join(comp, sets["cls"] == comp["node"], "left").select(
        "cls", "n", "shared", "bits", F.coalesce("component", "cls").alias("comp"), F.explode("prefix").alias("h")
    )
    # only buckets of two components or more matter; of each, the component with most members
    sizes = labelled.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    mixed = sizes.groupBy("h").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("top"))
    rest = F.col("total") - F.col("top.k")
    mixed = mixed.where("comps > 1").select(
        F.col("h").bitwiseXOR(F.lit(0)).alias("hh"), "total", F.col("top.comp").alias("main"),
        F.ceil(F.col("top.k") / SPLIT).cast("int").alias("pm"), F.ceil(rest / SPLIT).cast("int").alias("po"),
    )
    entry = labelled.join(mixed, F.col("h") == F.col("hh"))
    # a large bucket is split both ways: each part of the main component meets each part of the others, and these meet each other,
    # so a group has at most twice SPLIT members whatever a bucket is made of
    pm, po, mine = F.col("pm"), F.col("po"), lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    main = F.transform(upto(po), lambda j: mine(pm) * po + j)
    other = F.concat(F.transform(upto(pm), lambda i: i * po + mine(po)), F.transform(upto(po), lambda j: pm * po + F.least(mine(po), j) * po + F.greatest(mine(po), j)))
    part = F.when(F.col("total") <= 2 * SPLIT, F.array(F.lit(0))).when(F.col("comp") == F.col("main"), main).otherwise(other)
    dealt = entry.select(F.explode(part).alias("part"), "h", "cls", "n", "shared", "comp", "bits")
    dealt = dealt.select(F.xxhash64("h", "part").alias("h"), "cls", "n", "shared", "comp", "bits").withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(n)))
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(table):
        h = table.column("h").to_numpy()
        about = np.stack([table.column(k).to_numpy() for k in ("cls", "n", "shared", "comp")], axis=1).astype(I64)
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), dtype=np.uint8).reshape(-1, BITS // 8).view(U64)
        who = np.lexsort((about[:, 1], h))
        h = h[who]
        at = np.append(_exchange.firsts(h), len(h))
        found = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            members_ = who[lo:hi]
            ids, s, sh, c = about[members_].T
            if hi - lo < 2 or (c == c[0]).all():
                continue
            top = np.searchsorted(s, s * 100 // percent, side="right")  # members are sorted by size
            low = np.searchsorted(s, -(-s * percent // 100), side="left")
            if hubs is None:
                todo = [(i, i + 1) for i in range(hi - lo)]
            else:
                todo = [(i, low[i]) for i in np.lexsort((ids, -sh / s))[:hubs].tolist()]
            for i, start in todo:
                j = np.arange(start, top[i])
                both = s[i] + s[j]
                # an overlap of k links when k (100 + percent) >= percent (sum of sizes)
                j = j[(c[j] != c[i]) & (np.minimum(sh[j], sh[i]) * (100 + percent) >= both * percent)]
                if not len(j):
                    continue
                apart = np.bitwise_count(bits[members_[j]] ^ bits[members_[i]]).sum(axis=1, dtype=I64)
                most = (sh[j] + sh[i] - apart) // 2
                j = j[most * (100 + percent) >= (s[i] + s[j]) * percent]
                if len(j):
                    found.append(np.stack([np.minimum(ids[j], ids[i]), np.maximum(ids[j], ids[i])], axis=1))
            if len(found) > 2000:
                found = [np.unique(np.concatenate(found), axis=0)]
        got = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=I64)
        return pa.table({"a": got[:, 0], "b": got[:, 1]}, schema=kinds)

    return dealt.groupBy("bucket").applyInArrow(pairs, "a long, b long").distinct()


def class_components(docs: DataFrame, text_col: str = "text", size: int = SIZE, percent: int = PERCENT, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(node, component) of the classes that link with others, and the links found (a, b)."""
    spark = docs.sparkSession
    folder = _store.shared_dir(spark)
    src = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sets = _store.written(_survivors(_shared(src, size, seed), percent), folder, "sets")
    fits = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    hubs = _hub_pairs(sets).where(fits).select("a", "b").distinct()
    links = _store.written(_overlaps(hubs, sets, percent), folder, "links-1")
    comp = components(links, f"{folder}/links-1-components")
    for k, hubs in enumerate(HUBS, 2):
        pairs = _store.written(_cross_pairs(sets, comp, percent, hubs), folder, f"pairs-{k}")
        if pairs.isEmpty():
            continue  # no link can be missing in this round
        links = _store.written(_overlaps(pairs, sets, percent).unionByName(links), folder, f"links-{k}")
        comp = components(links, f"{folder}/links-{k}-components")
    return comp, links


def _labels(slim: DataFrame, comp: DataFrame, id_col: str) -> DataFrame:
    """(c, least_id): the least id of each class's component, from rows of ``members``."""
    least = slim.where("cls <> 0").groupBy("cls").agg(F.min(id_col).alias("first_id"))
    named = least.join(comp, F.col("cls") == F.col("node"), "left").select(
        "cls", "first_id", F.coalesce("component", "cls").alias("root")
    )
    roots = named.groupBy("root").agg(F.min("first_id").alias("least_id")).withColumnRenamed("root", "r")
    return named.join(roots, F.col("root") == F.col("r")).select(F.col("cls").alias("c"), "least_id")


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with n_shingles, cls (class of the shingle set) and component_id (least id that links reach)."""
    made = ["component_id", "least_id", "c"]
    src = docs.select(*[F.col(f"`{c}`") for c in _arrow.free_of(docs, made, keep=[id_col, text_col])])
    folder, seed = _store.shared_dir(docs.sparkSession), 0
    while True:
        known = _store.written(members(src, text_col, size, seed=seed), folder, f"members-{seed}")
        checks = known.groupBy("cls").agg(F.min("cls_check").alias("low"), F.max("cls_check").alias("high"))
        if checks.where("low <> high").isEmpty():
            break
        seed += 1
    comp, _ = class_components(src, text_col, size, percent, seed)
    labels = _labels(known.select(F.col(f"`{id_col}`").alias("id"), "cls"), comp, "id")
    got = known if drop_text else members(src, text_col, size, False, seed)
    return (
        got.join(labels, F.col("cls") == F.col("c"), "left")
        .withColumn("component_id", F.coalesce("least_id", F.col(f"`{id_col}`")))
        .drop("c", "least_id", "cls_check")
    )


def op4_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = _arrow.documents(spark, sf_dir).select("doc_id", "text")
    return ngram_join(docs, drop_text=True).select("doc_id", "n_shingles", "component_id", "cls")


def brute_force(rows: list[tuple], percent: int = PERCENT) -> dict:
    """(n_shingles, component_id) by comparing all pairs; for tests."""
    import re

    def shingle_set(t):
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[k : k + SIZE]) for k in range(max(1, len(w) - SIZE + 1))} if w else set()

    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}
