"""Directory entries to records with carry-forward semantics, in two dialects.

Rows are lines in reading order (volume, page, region, line). What a line leaves open is carried from earlier lines
of its volume: surname, given names, title, location. A carry is made in two steps: the last value inside the line's page, else
the last value of the pages before, which is a window over one row a page. So pages run in parallel, however large a volume is.
Rows without a volume or page take nothing from other pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions import patterns as P
from folioforge.functions import text as X
from folioforge.operators import sampling

ORDER = ("page", "region", "line_no")


def dash_run(line: Column) -> Column:
    return F.regexp_extract(line, P.DASH_RUN, 1)


def dash_count(line: Column) -> Column:
    """Dashes of the leading run: one repeats the surname, two or more the person."""
    return F.char_length(F.regexp_replace(dash_run(line), f"[^{P.DASHES}]", ""))


def fields(line: Column) -> Column:
    """Trimmed comma fields after the dash run."""
    return F.transform(F.split(F.regexp_replace(line, P.DASH_RUN, ""), ",", -1), X.strip)


def is_income_field(f: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(f, F.lit("")), "[^0-9]", "")) >= 2


def income_1936(last: Column) -> dict[str, Column]:
    """Of the last field: whether it is an income, and both sides."""
    pair, single = F.regexp_like(last, F.lit(P.INCOME_1936)), F.regexp_like(last, F.lit(P.ONLY_NUMBER_1936))
    left, right = F.regexp_extract(last, P.INCOME_1936, 1), F.regexp_extract(last, P.INCOME_1936, 2)
    return {
        "is_income": F.coalesce(pair | single, F.lit(False)),
        "municipal": F.when(pair, X.digits_as_int(left)).when(single, X.digits_as_int(last)),
        "state": F.when(pair, X.digits_as_int(right)),
    }


def income_1912(last: Column, split_spaces: bool = False) -> dict[str, Column]:
    """As ``income_1936``; number groups hold spaces unless ``split_spaces`` (the documented rule) is asked for."""
    groups = F.regexp_extract_all(last, F.lit("[0-9]+" if split_spaces else P.NUMBER_GROUP), F.lit(0))
    first, second = F.get(groups, F.lit(0)), F.get(groups, F.lit(1))
    at_dash = F.char_length(F.regexp_extract(last, f"^([^{P.DASHES}]*)[{P.DASHES}]", 1))
    dashed = F.regexp_like(last, F.lit(f"[{P.DASHES}]"))
    one, after = F.size(groups) == 1, dashed & (F.instr(last, first) - 1 >= at_dash)
    ok = is_income_field(last)
    return {
        "is_income": F.coalesce(ok, F.lit(False)),
        "municipal": F.when(ok & ~(one & after), X.digits_as_int(first)),
        "state": F.when(ok, F.when(F.size(groups) >= 2, X.digits_as_int(second)).when(one & after, X.digits_as_int(first))),
    }


def merge_lines_1936(lines: DataFrame, text: str = "text", keys=("page", "region"), order: str = "line_no") -> DataFrame:
    """Join a line to the one before where a word is broken or an income slipped to its own line.

    Whether two neighbours join depends on these two lines only, so the joined lines are islands between gaps.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    here = X.strip(F.col(text))
    before = F.regexp_replace(F.lag(text).over(w), r"\s+\z", "")
    broken = F.regexp_like(before, F.lit(f"{P.LETTER}-$")) & F.regexp_like(here, F.lit("^[a-zåäö]"))
    open_ended = before.endswith(",") | F.regexp_like(before, F.lit(rf"[{P.DASHES}]\s*$"))
    bump = open_ended & (F.regexp_like(here, F.lit(P.INCOME_1936)) | F.regexp_like(here, F.lit(P.ONLY_NUMBER_1936)))
    how = F.when(broken, "word").when(bump, "bump").otherwise("new")
    kept = lines.where(F.regexp_like(text, F.lit(r"\S"))).withColumn("_how", F.coalesce(how, F.lit("new")))
    kept = kept.withColumn("_next", F.lead("_how").over(w)).withColumn(
        "_group", F.sum(F.when(F.col("_how") == "new", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    own = F.regexp_replace(F.when(F.col("_how") == "new", F.col(text)).otherwise(here), r"\s+\z", "")
    piece = F.concat(
        F.when(F.col("_how") == "bump", " ").otherwise(""), F.when(F.col("_next") == "word", F.regexp_replace(own, "-$", "")).otherwise(own)
    )
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p")))), lambda x: x["p"]), "")
    return kept.groupBy(*keys, "_group").agg(F.min(order).alias(order), joined.alias(text)).drop("_group")


def merge_bumps_1912(lines: Column) -> Column:
    """Array of lines with slipped incomes joined to what has been joined so far: a fold, as each join changes the next test."""
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), F.lit(None).cast("string").alias("cur"))
    kept = F.filter(lines, lambda x: F.regexp_like(x, F.lit(r"\S")))

    def add(acc, x):
        here, cur = X.strip(x), acc["cur"]
        needs = cur.endswith(",") | F.regexp_like(cur, F.lit(rf"[{P.DASHES}]\s*$")) | ~is_income_field(F.element_at(F.split(cur, ",", -1), -1))
        joins = needs & F.regexp_like(here, F.lit(rf"^\s*[{P.DASHES}]?\s*[0-9]")) & (F.char_length(here) < P.BUMP_MAX_CHARS)
        own = F.regexp_replace(x, r"\s+\z", "")
        return F.struct(
            F.when(cur.isNull() | joins, acc["done"]).otherwise(F.array_append(acc["done"], cur)).alias("done"),
            F.when(cur.isNotNull() & joins, F.concat(cur, F.lit(" "), here)).otherwise(own).alias("cur"),
        )

    return F.aggregate(kept, start, add, lambda a: F.when(a["cur"].isNull(), a["done"]).otherwise(F.array_append(a["done"], a["cur"])))


def parse_records(lines: DataFrame, dialect: str = "1936", volume: str = "volume", split_spaces: bool = False) -> DataFrame:
    """Records of lines (volume, page, region, line_no, text; colL before colR by name).

    Adds surname, given_names, title, location, incomes and flags. In the 1912 dialect records without a
    surname, given name and income are dropped after they had their effect on what is carried.

    Lines meet the other lines of their page in one exchange. What a page leaves open is two answers about the pages before: is the
    surname that comes in an institution's, and is the title that comes in a wife's. So each page is read for every answer,
    a table of one row a page settles what comes in, volume by volume, and each line takes the reading that fits.
    """
    old = dialect == "1912"
    df = lines.withColumn("raw", X.strip(F.col("text"))).where("raw <> ''")
    df = df.withColumns({"n_dash": dash_count(F.col("raw")), "_f": fields(F.col("raw"))})
    last = F.element_at("_f", -1)
    income = income_1912(last, split_spaces) if old else income_1936(last)
    df = df.withColumns({"_is_income": income["is_income"], "municipal_income": income["municipal"], "state_income": income["state"]})
    less = lambda c: F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0)))
    rest = lambda c: F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))
    df = df.withColumn("_f", F.when(F.col("_is_income"), less("_f")).otherwise(F.col("_f")))
    head = F.coalesce(F.get("_f", F.lit(0)), F.lit(""))
    ditto = F.col("n_dash") >= 1
    if old:
        ditto = ditto | (F.regexp_like(head, F.lit(P.TITLE_FIRST)) & (F.size("_f") > 0))
    df = df.withColumns({"_ditto": ditto, "_same": F.col("n_dash") >= 2})

    page = Window.partitionBy(volume, "page").orderBy("region", "line_no")
    so_far, before = page.rowsBetween(Window.unboundedPreceding, 0), page.rowsBetween(Window.unboundedPreceding, -1)
    carried = lambda c, w: F.last(c, ignorenulls=True).over(w)
    # structs keep an empty value apart from none
    df = df.withColumns({"_own": F.when(~F.col("_ditto"), F.struct(head.alias("v"))), "_rest": F.when(F.col("_ditto"), F.col("_f")).otherwise(rest("_f"))})
    df = df.withColumn("_surname", carried("_own", so_far))
    first = F.coalesce(F.get("_rest", F.lit(0)), F.lit(""))
    answers = (0,) if old else (0, 1)
    both = [(i, w) for i in answers for w in answers]
    for i in answers:
        known = F.coalesce(F.regexp_like(F.col("_surname")["v"], F.lit(P.INSTITUTION)), F.lit(bool(i)))
        institution = F.lit(False) if old else (F.size("_rest") > 0) & (first.isin(*P.PARISHES) | known)
        loc = F.when(F.col("_same") | institution, F.col("_rest")).otherwise(rest("_rest"))
        df = df.withColumns({f"_given{i}": F.when(~F.col("_same"), F.struct(F.when(institution, "").otherwise(first).alias("v"))), f"_loc{i}": loc})
        place = F.coalesce(F.try_element_at(f"_loc{i}", F.lit(-1)), F.lit(""))
        df = df.withColumns({
            f"_place{i}": F.regexp_replace(place, r"\.+$", "") if old else place, f"_title{i}": F.array_join(F.filter(less(f"_loc{i}"), lambda x: x != ""), ", "),
        })
        # a row of the same person shows the carried title; only other rows' own titles are carried
        df = df.withColumn(f"_said{i}", F.when(~F.col("_same") & (F.col(f"_title{i}") != ""), F.col(f"_title{i}")))
        df = df.withColumns({f"_given_c{i}": carried(f"_given{i}", so_far), f"_title_c{i}": carried(f"_said{i}", before)})
    for i, w in both:
        if old:
            wife = F.regexp_like(F.regexp_replace("raw", P.DASH_RUN, ""), F.lit(P.WIFE))
        else:
            shown = F.when(F.col("_same"), F.col(f"_title_c{i}")).otherwise(F.col(f"_title{i}"))
            wife = F.regexp_like(F.concat_ws(" ", shown, F.array_join(f"_loc{i}", " ")), F.lit(P.WIFE)) | (F.col("_same") & F.col(f"_title_c{i}").isNull() & F.lit(bool(w)))
        df = df.withColumn(f"_wife{i}{w}", wife)
        df = df.withColumn(f"_settled{i}{w}", F.when(~F.col(f"_wife{i}{w}") & (F.col(f"_place{i}") != ""), F.col(f"_place{i}")))
        df = df.withColumn(f"_settled_c{i}{w}", carried(f"_settled{i}{w}", before))

    # what each page passes on, and what comes into it
    passed = ["_own", *[f"_{n}{i}" for i in answers for n in ("given", "said")], *[f"_settled{i}{w}" for i, w in both]]
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("region", "line_no")))
    pages = df.groupBy(volume, "page").agg(*[latest(c).alias(c) for c in passed])
    earlier = Window.partitionBy(volume).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    yes = lambda c, pattern: F.coalesce(F.regexp_like(c, F.lit(pattern)), F.lit(False)).cast("int")
    pick = lambda names, at: F.get(F.array(*[F.col(n) for n in names]), at)
    pages = pages.withColumn("_surname_in", carried("_own", earlier))
    pages = pages.withColumn("_i", F.lit(0) if old else yes(F.col("_surname_in")["v"], P.INSTITUTION))
    pages = pages.withColumns({"_given_in": carried(pick([f"_given{i}" for i in answers], F.col("_i")), earlier), "_title_in": carried(pick([f"_said{i}" for i in answers], F.col("_i")), earlier)})
    pages = pages.withColumn("_w", F.lit(0) if old else yes(F.col("_title_in"), P.WIFE))
    pages = pages.withColumn("_settled_in", carried(pick([f"_settled{i}{w}" for i, w in both], F.col("_i") * len(answers) + F.col("_w")), earlier))
    df = df.join(pages.select(volume, "page", "_surname_in", "_i", "_given_in", "_title_in", "_w", "_settled_in"), [volume, "page"], "left")
    i, w = F.coalesce("_i", F.lit(0)), F.coalesce("_w", F.lit(0))
    mine = lambda n: pick([f"_{n}{k}" for k in answers], i)
    ours = lambda n: pick([f"_{n}{a}{b}" for a, b in both], i * len(answers) + w)

    df = df.withColumns({"_place": mine("place"), "_wife": ours("wife")})
    own_title = mine("title")
    out = df.withColumns(
        {
            "surname": F.coalesce(F.col("_surname")["v"], F.col("_surname_in")["v"], F.lit("")),
            "given_names": F.coalesce(mine("given_c")["v"], F.col("_given_in")["v"], F.lit("")),
            "title": own_title if old else F.when(F.col("_same"), F.coalesce(mine("title_c"), "_title_in", F.lit(""))).otherwise(own_title),
            "location": F.when(F.col("_wife"), F.coalesce(ours("settled_c"), "_settled_in", "_place")).otherwise(F.col("_place")),
        }
    )
    out = out.withColumns(
        {
            "is_continuation_surname": F.col("_ditto").cast("int"),
            "is_same_person_2nd_loc": F.col("_same").cast("int"),
            "is_wife": F.col("_wife").cast("int"),
            "is_company": F.regexp_like("raw", F.lit(P.COMPANY)).cast("int"),
            "location_is_known_parish": F.col("location").isin(*P.PARISHES).cast("int"),
        }
    )
    if old:
        some_income = (F.coalesce("municipal_income", F.lit(0)) != 0) | (F.coalesce("state_income", F.lit(0)) != 0)
        out = out.where((F.col("surname") != "") | (F.col("given_names") != "") | some_income).drop("location_is_known_parish")
    return out.drop("text", "n_dash", *[c for c in out.columns if c.startswith("_")])


def with_record_ids(records: DataFrame, prefix: str, volume: str = "volume") -> DataFrame:
    """Running numbers in reading order: the place inside the page after the rows of the pages before."""
    pages = records.groupBy(volume, "page").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(volume).orderBy("page")) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy(volume, "page").orderBy("region", "line_no"))
    got = records.withColumn("_k", inside).join(pages.select(volume, "page", before.alias("_before")), [volume, "page"], "left")
    return got.withColumn("record_id", F.format_string(f"{prefix}_%06d", F.coalesce("_before", F.lit(0)) + F.col("_k"))).drop("_k", "_before")


def monotonicity(df: DataFrame, name: str, keys: list, order: list, minimum: float | None = None) -> DataFrame:
    """Share of neighbours in code-point order, case folded. ``minimum`` stands in where there is one row only.

    Neighbours are compared inside ranges of the order, then the last name of a range with the first of the next, so a key that holds
    most of the rows is spread over many tasks.
    """
    rows = sampling.ranged(df.select(*keys, *order, X.casefold(F.col(name)).alias("_b")), [*keys, *order])
    inside = Window.partitionBy("_p", *keys).orderBy(*order)
    step = rows.withColumn("_a", F.lag("_b").over(inside))
    at = F.struct(*order)
    ends = step.groupBy("_p", *keys).agg(
        F.count_if(F.col("_a") <= F.col("_b")).alias("_ok"), F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("_b"), at)["_b"].alias("_first"), F.max_by(F.struct("_b"), at)["_b"].alias("_last")
    )
    joint = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_p")) <= F.col("_first")
    ok, n = F.sum(F.col("_ok") + F.coalesce(F.col("_joint").cast("int"), F.lit(0))), F.sum("_n")
    share = ok / F.greatest(n - 1, F.lit(1))
    if minimum is not None:
        share = F.when(n == 1, F.lit(minimum)).otherwise(share)
    return ends.withColumn("_joint", joint).groupBy(*keys).agg(share.alias("monotonicity"), n.alias("n_names"))


def carry_last(df: DataFrame, value: Column, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with the last value that is not null up to each row, by key: inside ranges of the order, else from the ranges before."""
    rows = sampling.ranged(df.withColumn("_v", value), [*keys, *order])
    inside = Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_i", F.last("_v", ignorenulls=True).over(inside))
    ends = rows.groupBy("_p", *keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order))).alias("_l"))
    earlier = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("_p").alias("_q"), *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.last("_l", ignorenulls=True).over(earlier).alias("_before")).where("_before IS NOT NULL")
    on = F.col("_p") == F.col("_q")
    for n, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{n}"))
    got = rows.join(ends, on, "left").withColumn(name, F.coalesce("_i", "_before"))
    return got.drop("_v", "_p", "_i", "_q", "_before", *[f"_k{n}" for n in range(len(keys))])


def record_qa(records: DataFrame, volume: str = "volume") -> DataFrame:
    """One row for each volume: counts, rates and order of surnames. An income of 0 is no income."""
    income = (F.coalesce("municipal_income", F.lit(0)) != 0) | (F.coalesce("state_income", F.lit(0)) != 0)
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    cities = [F.array_sort(F.collect_set("city")).alias("cities")] if "city" in records.columns else []
    parish = [F.sum("location_is_known_parish").alias("known_parish_locations")] if "location_is_known_parish" in records.columns else []
    qa = records.groupBy(volume).agg(
        F.count(F.lit(1)).alias("records"),
        (F.count_if(income) / n).alias("pct_with_income"),
        (F.count_if(F.col("location") != "") / n).alias("pct_with_location"),
        F.sum("is_company").alias("companies"),
        F.sum("is_wife").alias("wives"),
        F.sum("is_continuation_surname").alias("continuation_surnames"),
        F.sum("is_same_person_2nd_loc").alias("same_person_2nd_loc"),
        *parish,
        *cities,
    )
    new = records.where("is_continuation_surname = 0 AND surname <> ''")
    mono = monotonicity(new, "surname", [volume], list(ORDER)).select(volume, F.col("monotonicity").alias("surname_monotonicity"))
    return qa.join(mono, volume, "left").fillna(0.0, ["surname_monotonicity"])


def city_of_page(top_text: Column) -> Column:
    """First city of the list that a page's top text names, whole or by its first five letters without spaces; else null."""
    low, tight = F.lower(top_text), F.replace(F.lower(top_text), F.lit(" "), F.lit(""))
    found = F.filter(
        F.array(*[F.lit(c) for c in P.CITIES]),
        lambda c: F.contains(low, F.lower(c)) | F.contains(tight, F.lower(F.substring(c, 1, 5))),
    )
    return F.get(found, F.lit(0))


def carry_city(pages: DataFrame, volume: str = "volume") -> DataFrame:
    """Pages (volume, page, city or null) with the last city known so far, empty before the first."""
    w = Window.partitionBy(volume).orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    return pages.withColumn("city", F.coalesce(F.last("city", ignorenulls=True).over(w), F.lit("")))
