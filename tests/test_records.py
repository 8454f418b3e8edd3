import pytest
from folioforge.operators import records as R
from pyspark.sql import functions as F

OLD = ["Holm, A., handl., O., 4100–3900", "hustru, 800–", "— B., ing., E., 5212 4600", "Lind, C., grossh., Kh.,", "7591 -8400", "– – Falun, 300–"]
NEW = [
    "Almqvist, K. G., direktör, O, 12500–11000", "– hustru, 3860—4210", "– Anna, fröken, E, 4200–", "– – Djursholm, –5100",
    "Berg, Erik, köpman, Mt,", "8 100–7 900", "– Greta, hustru, 900–", "Nordiska Fonden, A, 300–", "Bruks A.-B., Sundby, 20000–20000",
]
COLUMNS = ["surname", "given_names", "title", "location", "municipal_income", "state_income", "is_continuation_surname", "is_same_person_2nd_loc", "is_wife", "is_company"]


def lines(spark, texts, cuts=()):
    rows = [("v", 1 + sum(k >= c for c in cuts), "colL", k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "volume string, page int, region string, line_no int, text string")


@pytest.mark.parametrize("cuts", [(), (3, 6)])
def test_1936(spark, cuts):
    merged = R.merge_lines_1936(lines(spark, NEW, cuts), keys=("volume", "page", "region"))
    got = [tuple(r) for r in R.parse_records(merged).orderBy("page", "line_no").select(*COLUMNS, "location_is_known_parish").collect()]
    assert got == [
        ("Almqvist", "K. G.", "direktör", "O", 12500, 11000, 0, 0, 0, 0, 1),
        ("Almqvist", "hustru", "", "", 3860, 4210, 1, 0, 0, 0, 0),
        ("Almqvist", "Anna", "fröken", "E", 4200, None, 1, 0, 0, 0, 1),
        ("Almqvist", "Anna", "fröken", "Djursholm", None, 5100, 1, 1, 0, 0, 0),
        ("Berg", "Erik", "köpman", "Mt", 8100, 7900, 0, 0, 0, 0, 1),
        ("Berg", "Greta", "", "Mt", 900, None, 1, 0, 1, 0, 1),
        ("Nordiska Fonden", "", "", "A", 300, None, 0, 0, 0, 0, 1),
        ("Bruks A.-B.", "", "", "Sundby", 20000, 20000, 0, 0, 0, 1, 0),
    ]
    qa = R.record_qa(R.parse_records(merged)).first()
    assert qa["records"] == 8 and qa["pct_with_income"] == 1 and qa["pct_with_location"] == 7 / 8
    assert (qa["wives"], qa["companies"], qa["continuation_surnames"], qa["same_person_2nd_loc"]) == (1, 1, 4, 1)
    assert qa["surname_monotonicity"] == pytest.approx(2 / 3)


def test_word_break(spark):
    got = R.merge_lines_1936(lines(spark, ["Fidei-", "kommiss, 5–", " ", "Next, A, 5–"]), keys=("volume", "page", "region")).orderBy("line_no")
    assert [r["text"] for r in got.collect()] == ["Fideikommiss, 5–", "Next, A, 5–"]


@pytest.mark.parametrize("split", [False, True])
def test_1912(spark, split):
    df = lines(spark, OLD).groupBy("volume", "page", "region").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    df = df.select("volume", "page", "region", F.posexplode(R.merge_bumps_1912(F.transform("l", lambda x: x["text"]))).alias("line_no", "text"))
    got = [tuple(r) for r in R.parse_records(df, "1912", split_spaces=split).orderBy("line_no").select(*COLUMNS[:9]).collect()]
    assert got == [
        ("Holm", "A.", "handl.", "O", 4100, 3900, 0, 0, 0),
        ("Holm", "hustru", "", "O", 800, None, 1, 0, 1),
        ("Holm", "B.", "ing.", "E", *((5212, 4600) if split else (52124600, None)), 1, 0, 0),
        ("Lind", "C.", "grossh.", "Kh", 7591, 8400, 0, 0, 0),
        ("Lind", "C.", "", "Falun", 300, None, 1, 1, 0),
    ]


def test_ids_and_city(spark):
    merged = R.merge_lines_1936(lines(spark, NEW), keys=("volume", "page", "region"))
    ids = [r[0] for r in R.with_record_ids(R.parse_records(merged), "K1936").orderBy("record_id").select("record_id").collect()]
    assert ids[0] == "K1936_000001" and len(ids) == 8
    pages = spark.createDataFrame([("v", 1, ""), ("v", 2, "G Ö T E B  O R G 1912"), ("v", 3, "x"), ("v", 4, "Lundin")], "volume string, page int, top string")
    got = R.carry_city(pages.select("volume", "page", R.city_of_page(F.col("top")).alias("city"))).orderBy("page")
    assert [r["city"] for r in got.collect()] == ["", "Göteborg", "Göteborg", "Lund"]


@pytest.mark.parametrize("dialect", ["1936", "1912"])
def test_pages_do_not_matter(spark, dialect):
    """Records are the same whether all lines are on one page, each is on its own, or pages hold a few."""
    import random

    r = random.Random(11)
    heads = ["Berg", "Nordiska Fonden", "Ek A.-B.", "hustru", "–", "– –", "– Greta", "Lind", "", "Stiftelsen X"]
    parts = ["A", "Mt", "köpman", "hustru", "änkefru", "Karl", "Farsta", "", "O.", "fru hustru"]
    texts = [", ".join([r.choice(heads), *(r.choice(parts) for _ in range(r.randint(0, 4))), r.choice(["100–200", "–300", "", "7"])]) for _ in range(400)]
    seen = []
    for size in (400, 1, 7):
        rows = [("v", k // size, "colL", k, t) for k, t in enumerate(texts)]
        got = R.parse_records(spark.createDataFrame(rows, "volume string, page int, region string, line_no int, text string"), dialect)
        seen.append(sorted(tuple(x) for x in got.drop("page").collect()))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 300
