"""Consensus of several reads of one region: pair similarities, entropies, weights, clusters, alignments."""

from __future__ import annotations

import math
import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions import distance as D
from folioforge.functions import patterns as P
from folioforge.functions import similarity as S
from folioforge.functions import text as X

KEYS = ["page", "region"]


def spread(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads by region over all shuffle partitions. Their texts are small and their comparison is long, so partitions must not be
    put together by size, as adaptive execution does with a shuffle of its own."""
    n = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reads.repartition(n, *keys)


def pair_similarity(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine") -> DataFrame:
    """Unordered pairs of reads of one region: keys, a, b, ned, sim."""
    keys = keys or KEYS
    left = spread(reads.select(*keys, F.col(name).alias("a"), F.col(text).alias("_ta")), keys)
    right = spread(reads.select(*keys, F.col(name).alias("b"), F.col(text).alias("_tb")), keys)
    pairs = left.join(right, keys).where("a < b")
    return pairs.withColumn("ned", S.long_ned(F.col("_ta"), F.col("_tb"))).withColumn("sim", 1 - F.col("ned")).drop("_ta", "_tb")


def both_ways(pairs: DataFrame) -> DataFrame:
    swapped = pairs.withColumn("_x", F.col("a")).withColumn("a", F.col("b")).withColumn("b", F.col("_x")).drop("_x")
    return pairs.unionByName(swapped)


def pairwise_cer(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine") -> DataFrame:
    """Mean distance and number of shared regions of each ordered engine pair; the diagonal is 0 with count 0."""
    pairs = pair_similarity(reads, keys, text, name)
    half = pairs.groupBy("a", "b").agg(F.avg("ned").alias("mean_cer"), F.count(F.lit(1)).alias("n_shared"))
    diagonal = reads.select(F.col(name).alias("a")).distinct().select("a", F.col("a").alias("b"), F.lit(0.0).alias("mean_cer"), F.lit(0).cast("long").alias("n_shared"))
    return both_ways(half).unionByName(diagonal)


def engine_centrality(cer: DataFrame) -> DataFrame:
    """Mean distance of each engine to the others, with its rank."""
    mean = cer.where("a <> b").groupBy(F.col("a").alias("engine")).agg(F.avg("mean_cer").alias("mean_cer"))
    return mean.withColumn("rank", F.row_number().over(Window.orderBy("mean_cer", "engine")))


def _region_table(reads: DataFrame, keys: list[str], text: str, name: str, threshold: float, extra: list[str] = ()) -> DataFrame:
    """One row a region with arrays over its reads (in order of ``name``): entropy, weight, label; and n, mean_sim, delta, fraction, cluster.

    A region has as many reads as there are engines, so its similarity matrix is a small array of one row and the whole
    consensus is one exchange. Sums leave out a read's similarity to itself instead of taking it off again, which would
    round, and the mean similarity has twelve decimals, so that neither depends on the order of the reads. A read's similarities to the others are a distribution; its entropy is low where it
    stands with few of them. A read without any similarity gets the largest entropy of the region (or ln n). delta is the spread of
    entropies over ln n. Labels of single-linkage clusters spread over links by repeated minima.
    """
    item = F.struct(F.col(name).alias("e"), F.col(text).alias("t"), *[F.col(c) for c in extra])
    df = spread(reads.select(*keys, name, text, *extra), keys).groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_m"))
    df = df.withColumn("n", F.size("_m"))
    df = df.withColumn("_s", S.similarity_matrix(F.transform("_m", lambda x: x["t"])))
    others = lambda row, i: F.aggregate(F.transform(row, lambda v, k: F.when(k == i, 0.0).otherwise(v)), F.lit(0.0), lambda a, v: a + v)
    df = df.withColumn("_sum", F.transform("_s", others))

    def entropy(row, i):
        total = F.get(F.col("_sum"), i)
        term = lambda v, k: F.when((k != i) & (v > 0), -(v / total) * F.log(v / total)).otherwise(0.0)
        return F.when(total > 1e-9, F.aggregate(F.transform(row, term), F.lit(0.0), lambda a, v: a + v))

    df = df.withColumn("_h", F.transform("_s", entropy))
    df = df.withColumn("entropy", F.transform("_h", lambda h: F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(h, F.array_max("_h"), F.log(F.col("n"))))))
    df = df.withColumn("_w", F.transform("entropy", lambda h: 1 / (h + 1e-9)))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    df = df.withColumn("_wsum", total("_w")).withColumn("weight", F.transform("_w", lambda w: w / F.col("_wsum")))
    df = df.withColumn("_mean", total("entropy") / F.col("n"))
    deviation = F.sqrt(total(F.transform("entropy", lambda h: (h - F.col("_mean")) * (h - F.col("_mean")))) / F.col("n"))
    pairs = (F.col("n") * (F.col("n") - 1)).cast("double")
    df = df.withColumns(
        {
            "delta": F.when(F.col("n") > 1, F.greatest(F.lit(0.0), F.least(F.lit(1.0), deviation / F.log(F.col("n"))))).otherwise(0.0),
            "mean_sim": F.when(F.col("n") > 1, F.round(total("_sum") / F.greatest(pairs, F.lit(1.0)), 12)).otherwise(1.0),
            "label": F.aggregate(
                F.sequence(F.lit(1), F.col("n")),
                F.sequence(F.lit(0), F.col("n") - 1),
                lambda labels, _: F.transform("_s", lambda row: F.array_min(F.transform(row, lambda v, j: F.when(v >= threshold, F.get(labels, j))))),
            ),
        }
    )
    each = F.arrays_zip(F.col("weight").alias("w"), F.col("label").alias("l"))
    per_label = F.transform(
        F.array_distinct("label"), lambda c: F.struct((-F.round(total(F.transform(F.filter(each, lambda x: x["l"] == c), lambda x: x["w"])), 12)).alias("w"), c.alias("c"))
    )
    df = df.withColumn("_best", F.array_min(per_label))
    return df.withColumns({"fraction": -F.col("_best.w"), "cluster": F.col("_best.c")}).drop("_s", "_sum", "_h", "_w", "_wsum", "_mean", "_best")


def _each_read(table: DataFrame, keys: list[str], name: str) -> DataFrame:
    zipped = F.arrays_zip(F.col("_m").alias("m"), F.col("entropy").alias("entropy"), F.col("weight").alias("weight"), F.col("label").alias("label"))
    label = F.get(F.col("_m"), F.col("x.label"))["e"]
    return table.select(*keys, "_m", F.explode(zipped).alias("x")).select(*keys, F.col("x.m.e").alias(name), F.col("x.entropy").alias("entropy"), F.col("x.weight").alias("weight"), label.alias("cluster"))


def consensus_entropy(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine") -> tuple[DataFrame, DataFrame]:
    """Per read: entropy and weight; per region: n, mean_sim, delta."""
    keys = keys or KEYS
    table = _region_table(reads, keys, text, name, P.CLUSTER_SIM)
    return _each_read(table, keys, name).drop("cluster"), table.select(*keys, F.col("n").cast("long").alias("n"), "delta", "mean_sim")


def clusters(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine", threshold: float = P.CLUSTER_SIM) -> DataFrame:
    """Single-linkage cluster of each read, named by its least member."""
    keys = keys or KEYS
    return _each_read(_region_table(reads, keys, text, name, threshold), keys, name).select(*keys, name, "cluster")


def cluster_fraction(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine", threshold: float = P.CLUSTER_SIM) -> DataFrame:
    """Share of weight of the heaviest cluster of each region (the one with the least member on ties), and that cluster."""
    keys = keys or KEYS
    table = _region_table(reads, keys, text, name, threshold)
    return table.select(*keys, F.col("fraction").alias("cluster_fraction"), F.get(F.col("_m"), F.col("cluster"))["e"].alias("cluster"))


def _representative(shown: Column) -> Column:
    """Of the heaviest cluster the read of most weight, then the longest, then the least text: struct<w, l, t, e>."""
    inside = F.filter(F.arrays_zip(F.col("_m").alias("m"), F.col("weight").alias("w"), F.col("label").alias("c"), shown.alias("t")), lambda x: x["c"] == F.col("cluster"))
    return F.array_min(F.transform(inside, lambda x: F.struct((-F.round(x["w"], 12)).alias("w"), (-F.char_length(x["t"])).alias("l"), x["t"].alias("t"), x["m"]["e"].alias("e"))))


def pick_read(reads: DataFrame, keys: list[str] | None = None, text: str = "text", name: str = "engine", threshold: float = P.CLUSTER_SIM) -> DataFrame:
    """The consensus read of each region of two reads or more."""
    keys = keys or KEYS
    table = _region_table(reads, keys, text, name, threshold).where("n >= 2")
    best = table.withColumn("_b", _representative(F.transform("_m", lambda m: m["t"])))
    return best.select(*keys, F.col("_b.e").alias(name), F.col("_b.t").alias("text"), F.col("fraction").alias("agreement"))


# alignments: inherently sequential, one region at a time


class Similar:
    """Similarities of pairs of forms: those of ``pairs`` are measured together, any other when it is asked for."""

    def __init__(self, pairs=()):
        ordered = list({(min(p), max(p)) for p in pairs if p[0] != p[1]})
        got = D.distances([a for a, _ in ordered], [b for _, b in ordered])
        self.of = {p: 1 - int(d) / max(len(p[0]), len(p[1])) for p, d in zip(ordered, got, strict=True)}

    def __call__(self, a: str, b: str) -> float:
        if a == b:
            return 1.0
        key = (min(a, b), max(a, b))
        if key not in self.of:
            self.of[key] = 1 - D.ned(a, b)
        return self.of[key]


def _bound(a: str, b: str) -> float:
    """The most that two forms of these lengths can be alike."""
    longer = max(len(a), len(b))
    return 1 - abs(len(a) - len(b)) / longer if longer else 1.0


def _best(here: str, forms: list[str], places, floor: float, similar: Similar) -> tuple[float, int | None]:
    """The most similar form among ``places`` and its place, the first on ties; pairs whose lengths alone rule out
    more than ``floor`` are not compared."""
    best, at = floor, None
    for k in places:
        if _bound(here, forms[k]) <= best:
            continue
        s = similar(here, forms[k])
        if s > best:
            best, at = s, k
    return best, at


def _compare(s: str) -> str:
    s = re.sub(P.MATH_TAG, "", unicodedata.normalize("NFKC", s or ""))
    return " ".join(re.sub(f"[{P.COMPARE_DASHES}]", "-", s).split()).casefold()


def _light(s: str) -> str:
    return " ".join((s or "").lower().split())


def _comparable(reads: dict[str, list[str]], threshold: float, ordered: bool):
    """Pairs of forms of different engines that the alignment may ask for."""
    forms = {e: [(_light if ordered else _compare)(t) for t in texts] for e, texts in reads.items()}
    spine = max(forms, key=lambda e: len(forms[e])) if forms else None
    names = list(forms)
    for k, x in enumerate(names):
        for y in names[k + 1 :]:
            if not ordered or spine in (x, y):
                yield from ((a, b) for a in forms[x] for b in forms[y] if _bound(a, b) >= threshold)


def align_free(reads: dict[str, list[str]], threshold: float = P.ALIGN_SIM, similar: Similar | None = None) -> list[dict[str, str]]:
    """Groups of lines believed to be one, without regard to order: each line goes to the best group, above the threshold, that its engine has not used."""
    if not reads:
        return []
    similar = similar or Similar()
    anchor = max(reads, key=lambda e: len(reads[e]))  # the first of the longest
    groups = [{anchor: t} for t in reads[anchor]]
    forms = [_compare(t) for t in reads[anchor]]
    for engine, texts in reads.items():
        if engine == anchor:
            continue
        for t in texts:
            form = _compare(t)
            _, at = _best(form, forms, (k for k in range(len(groups)) if engine not in groups[k]), threshold, similar)
            if at is not None:
                groups[at][engine] = t
            else:
                groups.append({engine: t})
                forms.append(form)
    return groups


def align_ordered(
    reads: dict[str, list[str]], threshold: float = P.SPINE_SIM, ahead: int = P.SPINE_AHEAD, back: int = P.SPINE_BACK, similar: Similar | None = None
) -> list[dict[str, str]]:
    """Slots of lines in order along the longest read. Lines that match no slot stand as slots of their own before the
    slot at which their engine was; all of them stay, also where the engine stepped back."""
    reads = {e: t for e, t in reads.items() if t}
    if not reads:
        return []
    similar = similar or Similar()
    spine = max(reads, key=lambda e: len(reads[e]))
    slots = [{spine: t} for t in reads[spine]]
    for engine, texts in reads.items():
        if engine == spine:
            continue
        forms, at, extra = [_light(s.get(spine, "")) for s in slots], 0, []
        for order, t in enumerate(texts):
            here = _light(t)
            hit = None
            for window in (range(at, min(len(slots), at + ahead + 1)), range(max(0, at - back), at)):
                # "at least the threshold" is "more than the next smaller number"
                _, hit = _best(here, forms, (k for k in window if engine not in slots[k]), math.nextafter(threshold, 0), similar)
                if hit is not None:
                    break
            if hit is None:
                extra.append((at, order, t))
            else:
                slots[hit][engine] = t
                at = hit + 1
        merged = []
        extra.sort()
        for k in range(len(slots) + 1):
            merged += [{engine: t} for place, _, t in extra if place == k]
            merged += slots[k : k + 1]
        slots = merged
    return slots


#: pairs of lines that are measured together
PAIRS_AT_ONCE = 50_000


def aligned_lines(reads: DataFrame, keys: list[str] | None = None, ordered: bool = False, threshold: float | None = None) -> DataFrame:
    """Line members of each region: keys, slot, engine, text. A region is one row with its reads, which are what fits a page;
    the distances of many regions are measured together."""
    keys = keys or KEYS
    limit = threshold if threshold is not None else (P.SPINE_SIM if ordered else P.ALIGN_SIM)
    split = X.lines(F.col("text")) if ordered else X.engine_lines(X.nfkc(F.col("text")), F.col("engine"))
    src = spread(reads.select(*keys, "engine", split.alias("lines")), keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("engine", "lines"))).alias("_r"))
    schema = T.StructType([*(src.schema[k] for k in keys), T.StructField("slot", T.IntegerType()), T.StructField("engine", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, align = to_arrow_schema(schema), align_ordered if ordered else align_free

        def flush():
            similar, rows = Similar(p for _, pairs in held for p in pairs), []
            for row, _ in held:
                slots = align(row["_r"], limit, similar=similar)
                rows += [tuple(row[k] for k in keys) + (k, e, t) for k, slot in enumerate(slots) for e, t in slot.items()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)], schema=arrow)

        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                row["_r"] = {r["engine"]: r["lines"] or [] for r in row["_r"]}
                held.append((row, list(_comparable(row["_r"], limit, ordered))))
                size += len(held[-1][1])
                if size >= PAIRS_AT_ONCE or len(held) >= PAIRS_AT_ONCE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return src.mapInArrow(run, schema)


def band(mean_sim: Column) -> Column:
    return F.when(mean_sim >= P.HIGH_AGREEMENT, "HIGH").when(mean_sim < P.LOW_AGREEMENT, "LOW").otherwise("MID")


def line_groups(members: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per slot: members, representative (longest, first engine on ties), mean_sim and agreement; a line of one engine has neither."""
    keys = keys or KEYS
    forms = members.withColumn("_form", X.compare_form(F.col("text")))
    table = _region_table(forms, [*keys, "slot"], "_form", "engine", P.CLUSTER_SIM, ["text"])
    rep = F.array_min(F.transform("_m", lambda m: F.struct((-F.char_length(m["text"])).alias("l"), m["e"].alias("e"), m["text"].alias("t"))))["t"]
    several = F.col("n") >= 2
    got = table.select(
        *keys, "slot", F.col("n").cast("long").alias("n_engines_on_line"), F.map_from_entries(F.transform("_m", lambda m: F.struct(m["e"], m["text"]))).alias("members"),
        rep.alias("representative"), F.array_join(F.transform("_m", lambda m: m["e"]), "|").alias("engines"),
        F.when(several, F.col("mean_sim")).otherwise(0.0).alias("mean_sim"), F.when(several, 1 - F.col("delta")).otherwise(0.0).alias("agreement"),
    )
    return got.withColumn("band", band(F.col("mean_sim")))


def analyze_regions(reads: DataFrame, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Regions of two engines or more: whole-text consensus and line statistics; and their line groups."""
    keys = keys or KEYS
    several = reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2").select(*keys)
    reads = reads.join(several, keys)
    full = reads.withColumn("text", X.compare_form(F.array_join(X.engine_lines(X.nfkc(F.col("text")), F.col("engine")), " ")))
    _, ce = consensus_entropy(full, keys)
    fraction = cluster_fraction(full, keys).select(*keys, F.col("cluster_fraction").alias("cluster_consensus_frac"))
    groups = line_groups(aligned_lines(reads, keys), keys)
    multi = F.col("n_engines_on_line") >= 2
    lines = groups.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.coalesce(F.avg(F.when(multi, F.col("mean_sim"))), F.lit(0.0)).alias("mean_line_agreement"),
        F.count_if(multi & (F.col("mean_sim") >= P.HIGH_AGREEMENT)).alias("n_high_conf_lines"),
        F.count_if(F.col("mean_sim") < P.LOW_AGREEMENT).alias("n_low_conf_lines"),
    )
    engines = reads.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("engine")), "|").alias("engines"))
    got = ce.join(fraction, keys).join(lines, keys, "left").join(engines, keys).fillna(0, ["n_lines", "mean_line_agreement", "n_high_conf_lines", "n_low_conf_lines"])
    got = got.withColumn("region_agreement", 1 - F.col("delta")).withColumnsRenamed({"n": "n_engines", "mean_sim": "region_mean_sim"}).drop("delta")
    return got, groups


def fuse_regions(reads: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fused lines: keys, line_idx, text, confidence, n_votes, votes. With one engine its lines pass with confidence 1."""
    keys = keys or KEYS
    reads = reads.where(F.regexp_like("text", F.lit(r"\S")))
    forms = aligned_lines(reads, keys, ordered=True).withColumn("_form", X.light_form(F.col("text")))
    table = _region_table(forms, [*keys, "slot"], "_form", "engine", P.FUSE_SIM, ["text"])
    best = table.withColumn("_b", _representative(F.transform("_m", lambda m: m["text"])))
    n_engines = reads.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_engines"))
    alone = F.col("n_engines") == 1
    return best.join(n_engines, keys).select(
        *keys, F.col("slot").alias("line_idx"), F.col("_b.t").alias("text"), F.when(alone, 1.0).otherwise(F.col("fraction")).alias("confidence"),
        F.when(alone, 0.0).otherwise(F.col("delta")).alias("delta"), F.col("n").cast("long").alias("n_votes"),
        F.map_from_entries(F.transform("_m", lambda m: F.struct(m["e"], m["text"]))).alias("votes"), "n_engines",
    )


def fused_text(fused: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or KEYS
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "text"))), lambda x: x["text"]), "\n")
    return fused.groupBy(*keys).agg(text.alias("fused_text"), F.avg("confidence").alias("mean_agreement"), F.avg("delta").alias("mean_delta"), F.first("n_engines").alias("n_engines"))


def anchored_agreement(reads: DataFrame, anchor: str, keys: list[str] | None = None) -> DataFrame:
    """Lines of the anchor engine with how well others corroborate them, looked for in a band around the same relative place.

    keys, line_idx, text, agreement (mean of the best ratios, null without others), n_corrob, sims (by engine).
    """
    keys = keys or KEYS
    lines = spread(reads.select(*keys, "engine", X.lines(F.col("text")).alias("_l")).where(F.size("_l") > 0), keys)
    mine = lines.where(F.col("engine") == anchor).select(*keys, F.col("_l").alias("_mine"))
    # a row for each read of another engine, which holds its lines: no line is paired with lines as rows
    others = mine.join(lines.where(F.col("engine") != anchor), keys).select(*keys, "engine", S.best_ratios(F.col("_mine"), F.col("_l")).alias("_b"))
    best = others.select(*keys, "engine", F.posexplode("_b").alias("line_idx", "_r"))
    per_line = best.groupBy(*keys, "line_idx").agg(
        F.round(F.avg(F.round("_r", 3)), 4).alias("agreement"), F.count_if(F.col("_r") >= P.CORROBORATED).alias("n_corrob"),
        F.map_from_entries(F.collect_list(F.struct("engine", F.round("_r", 3)))).alias("sims"),
    )
    shown = mine.select(*keys, F.posexplode("_mine").alias("line_idx", "text"))
    return shown.join(per_line, [*keys, "line_idx"], "left").fillna(0, ["n_corrob"])


def flagged(lines: DataFrame) -> DataFrame:
    """Lines for review: agreement known and low; text cut to 200."""
    return lines.where(F.col("agreement").isNotNull() & (F.col("agreement") < P.LOW_AGREEMENT)).withColumn("text", F.substring("text", 1, 200))


def report_totals(regions: DataFrame, groups: DataFrame) -> DataFrame:
    low = F.col("mean_sim") < P.LOW_AGREEMENT
    g = groups.agg(F.count_if(low & (F.col("n_engines_on_line") == 1)).alias("singletons"), F.count_if(low & (F.col("n_engines_on_line") > 1)).alias("disagreements"))
    r = regions.agg(
        F.count(F.lit(1)).alias("regions"), F.sum("n_engines").alias("reads"), F.avg("region_mean_sim").alias("mean_sim"), F.avg("mean_line_agreement").alias("mean_line_agreement"),
        F.sum("n_high_conf_lines").alias("high_lines"), F.sum("n_low_conf_lines").alias("low_lines"),
    )
    return r.crossJoin(g)  # one row and one row


def samples(groups: DataFrame, keys: list[str] | None = None, high: bool = False) -> DataFrame:
    """Disagreements (5 a region, 25 in all) or, if ``high``, lines of four engines that agree (8 and 12)."""
    keys = keys or KEYS
    keep = (F.col("band") == "HIGH") & (F.col("n_engines_on_line") >= 4) if high else (F.col("band") == "LOW") & (F.col("n_engines_on_line") >= 2)
    per, total = (8, 12) if high else (5, 25)
    w = Window.partitionBy(*keys).orderBy("slot")
    return groups.where(keep).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per).orderBy(*keys, "slot").limit(total).drop("_k")


def worst_regions(regions: DataFrame, n: int = 15) -> DataFrame:
    return regions.orderBy("region_mean_sim", *KEYS).limit(n)

