"""Hand-made survey tables with nulls, ties, gaps and misspellings."""

import pytest
from pyspark.sql import functions as F

from segspark.functions import columns as c
from segspark.functions import fixed
from segspark.operators import tables as t
from segspark.operators.features import BrandSpec, build_features
from segspark.operators.scaling import standardized, winsorize
from segspark.plans import cleaners
from segspark.plans.integrate import integrate

FOCAL = "Acme"


def values(df, *columns):
    return [tuple(r[x] for x in columns) for r in df.collect()]


def test_strip_removes_every_kind_of_space(spark):
    df = spark.createDataFrame([("\t a b \r\n",), (" Trà sữa ",), (None,), ("",)], "s string")
    assert values(df.select(c.strip("s").alias("s")), "s") == [("a b",), ("Trà sữa",), (None,), ("",)]


def test_strip_knows_all_white_space_and_no_regular_expression(spark, capsys):
    spaces = [chr(x) for x in range(0x3001) if chr(x).isspace() and not 0x1C <= x <= 0x1F]
    texts = [f"{x}a{x}b{x}{x}" for x in spaces] + ["".join(spaces), "\u200ba\u200b", "\u180ea", "\x1ca", "a\n \n"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, s string")
    out = df.select("s", c.strip("s").alias("t"), F.regexp_replace("s", r"(?U)^\s+|\s+$", "").alias("u"))
    assert len(spaces) == 25 and all(r["t"] == r["u"] for r in out.collect())
    capsys.readouterr()
    df.select(c.strip("s")).explain()
    assert "regexp" not in capsys.readouterr().out


def test_spelling_and_replacement(spark):
    df = spark.createDataFrame([("Indepentdent",), ("Indepedent Cafe",), ("Other",), (None,)], "b string")
    assert values(df.select(c.fix_brand_spelling("b").alias("b")), "b") == [
        ("Independent",), ("Independent Cafe",), ("Other",), (None,)
    ]


@pytest.mark.parametrize("x,band", [
    (None, None), (-1.0, None), (0.0, 0), (2999.0, 0), (3000.0, 1), (4499.99, 1), (6500.0, 3),
    (74999.0, 11), (75000.0, 12), (1e9, 12),
])
def test_income_band_edges(spark, x, band):
    got = spark.createDataFrame([(x,)], "x double").select(c.income_band("x")).first()[0]
    assert got == (None if band is None else fixed.INCOME_BANDS[band][1])


@pytest.mark.parametrize("x,seg,strict", [
    (-1.0, 0, 0), (24999.0, 1, 1), (25000.0, 2, 2), (59000.0, 2, 2), (59500.0, 4, 2), (60000.0, 3, 3),
    (99000.0, 3, 3), (99500.0, 4, 4), (100000.0, 4, 4), (None, 4, 0),
])
def test_segments_with_their_gaps(spark, x, seg, strict):
    row = spark.createDataFrame([(x,)], "x double").select(c.spend_segment("x"), c.spend_segment("x", strict=True)).first()
    assert [int(v[4:6]) for v in row] == [seg, strict]


def test_nps_fill_and_group(spark):
    s4, s3, s2, s1 = (fixed.SEGMENT_SUPER_PREMIUM, fixed.SEGMENT_PREMIUM, fixed.SEGMENT_MASS_ASPIRING, fixed.SEGMENT_MASS)
    rows = [(7.0, FOCAL, s4), (None, FOCAL, s1), (None, "x", s4), (None, None, s3), (None, "x", s2), (None, "x", s1)]
    df = spark.createDataFrame(rows, "n double, l string, s string").select(c.nps_filled("n", "l", "s", FOCAL).alias("n"))
    assert values(df.select("n", c.nps_group("n").alias("g")), "n", "g") == [
        (7.0, "Detractive"), (9.0, "Promoter"), (9.0, "Promoter"), (9.0, "Promoter"), (8.0, "Passive"), (-1.0, "Detractive"),
    ]


def test_ratio_is_recomputed_unless_marked(spark):
    rows = [(None, 10.0, 4.0), (-1.0, 10.0, 4.0), (3.0, 10.0, 0.0), (3.0, 10.0, 5.0), (3.0, None, 5.0)]
    df = spark.createDataFrame(rows, "p double, s double, f double").select(c.ratio_refreshed("p", "s", "f").alias("p"))
    assert values(df, "p") == [(2.5,), (-1.0,), (3.0,), (2.0,), (None,)]


HEALTH = (
    "ID long, Year int, City string, Brand string, Spontaneous string, Awareness string, Trial string, P3M string, "
    "P1M string, Weekly string, Daily string, Brand_Likability string, Comprehension string, `Fre#visit` double, "
    "PPA double, Spending double, Spending_use double, `NPS#P3M` double"
)


def health(spark, *rows):
    names = [f.strip().split(" ")[0].strip("`") for f in HEALTH.split(",")]
    base = dict(ID=1, Year=2017, City="X", Brand="Own", Awareness="B")
    return spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], HEALTH)


def test_fill_order_of_the_funnel(spark):
    df = health(
        spark,
        dict(ID=1, P3M=None, P1M=None, Weekly="W"),
        dict(ID=2, Daily="D", Weekly="W"),
        dict(ID=3, P1M="M", Daily="D"),
        dict(ID=4),
        dict(ID=5, Awareness=FOCAL),
    )
    got = values(cleaners.fill_funnel(df, FOCAL).orderBy("ID"), "Spontaneous", "P3M", "P1M", "Comprehension")
    assert got == [
        ("B", "W", "W", "Unknown"), ("B", "D", "D", "Unknown"), ("B", "M", "M", "Unknown"),
        ("B", "Unknown", "Unknown", "Unknown"), (FOCAL, "Unknown", "Unknown", "Know a little"),
    ]


def test_trial_needs_all_evidence(spark):
    every = dict(P3M=FOCAL, P1M=FOCAL, Brand_Likability=FOCAL, Weekly=FOCAL, Daily=FOCAL, Awareness=FOCAL)
    df = health(spark, dict(ID=1, **every), dict(ID=2, **{**every, "Daily": None}), dict(ID=3, Trial="T", **every))
    assert values(cleaners.fill_funnel(df, FOCAL).orderBy("ID"), "Trial") == [(FOCAL,), ("Unknown",), ("T",)]


def test_absent_answers_are_left_out(spark):
    df = spark.createDataFrame([(1, None, FOCAL), (2, None, "x")], "ID int, Trial string, Daily string")
    out = cleaners.fill_visits(cleaners.fill_funnel(df, FOCAL), FOCAL)
    assert out.columns == ["ID", "Trial", "Daily"] and values(out.orderBy("ID"), "Trial") == [(FOCAL,), ("Unknown",)]


def test_visits_take_the_median_only_with_evidence(spark):
    df = health(
        spark, dict(ID=1, **{"Fre#visit": 2.0}), dict(ID=2, **{"Fre#visit": 5.0}),
        dict(ID=3, Weekly=FOCAL), dict(ID=4, Weekly="x"),
    )
    df = cleaners.fill_funnel(t.rename_present(df, {"Fre#visit": "Frequency_Visit"}), FOCAL)
    assert values(cleaners.fill_visits(df, FOCAL).orderBy("ID"), "Frequency_Visit") == [(2.0,), (5.0,), (3.5,), (0.0,)]


def test_likability_falls_back_to_the_last_image(spark):
    df = health(
        spark, dict(ID=1, **{"Fre#visit": 4.0}), dict(ID=2, **{"Fre#visit": 3.0}), dict(ID=3, **{"Fre#visit": 1.0}),
        dict(ID=4, Brand_Likability="L"),
    ).withColumnRenamed("Fre#visit", "Frequency_Visit")
    image = spark.createDataFrame([(2, 1, "old"), (2, 2, "new"), (4, 1, "z")], "ID long, n int, BrandImage string")
    out = cleaners.fill_likability(t.cast_key(df), image, ["n"])
    assert values(out.orderBy("ID"), "Brand_Likability") == [("Own",), ("new",), ("Unknown",), ("L",)]
    with pytest.raises(ValueError):
        cleaners.fill_likability(df, image, None)


def test_whole_health_cleaner(spark):
    df = health(
        spark,
        dict(ID=1, Trial=FOCAL, Spending=30000.0, Spending_use=30000.0, PPA=1.0, **{"Fre#visit": 4.0}),
        dict(ID=1, Trial=FOCAL, Spending=30000.0, Spending_use=30000.0, PPA=1.0, **{"Fre#visit": 4.0}),
        dict(ID=2, Trial="x", Spending=80000.0, Spending_use=80000.0, **{"Fre#visit": 2.0, "NPS#P3M": 10.0}),
        dict(ID=3, Awareness=None),
    )
    out = cleaners.clean_brandhealth(df, FOCAL).orderBy("ID").collect()
    assert [r["ID"] for r in out] == ["1", "2"]
    assert "Spending_use" not in out[0].asDict()
    assert out[0]["PPA"] == 7500.0 and out[0]["Segmentation"] == fixed.SEGMENT_MASS_ASPIRING
    assert out[1]["PPA"] == -1.0 and out[1]["Segmentation"] == fixed.SEGMENT_MASS
    assert out[1]["NPS_P3M_Group"] == "Promoter" and out[0]["Weekly"] == "Unknown"
    assert out[0]["Spending"] == pytest.approx(30000 * 0.99) and out[1]["Spending"] == pytest.approx(300)


def test_copy_column_is_kept_when_it_differs(spark):
    df = spark.createDataFrame([(1, 1), (None, None), (2, 2)], "a int, b int")
    assert t.drop_copy_column(df, "a", "b").columns == ["a"]
    other = spark.createDataFrame([(1, 1), (None, 3)], "a int, b int")
    assert t.drop_copy_column(other, "a", "b").columns == ["a", "b"]


def test_demographics(spark):
    df = spark.createDataFrame(
        [
            (1, " Hanoi ", 2.0, 30.0, 2000.0, "Indepentdent Cafe", "B ", "C", None, None, "20 - 24 y.o.", "a", "Col", "g"),
            (2, "Hue", None, 30.0, 2000.0, "A", "B", "C", "P", "given", "45+ y.o.", "a", "Col", "g"),
            (3, "Hue", 1.0, 30.0, None, "A", "B", "C", "P", "given", "45+ y.o.", "a", "Col", "g"),
            (4, "Hue", 1.0, 30.0, -5.0, "A", "B", "C", "P", None, "45+ y.o.", "a", "Col", "g"),
        ],
        "ID long, City string, Group_size double, Age double, `MPI#Mean` double, TOM string, BUMO string, "
        "MostFavourite string, BUMO_Previous string, `MPI#detail` string, `Age#Group#2` string, `Age#group` string, "
        "Col string, `Occupation#group` string",
    )
    out = cleaners.clean_demographics(df).orderBy("ID")
    assert "Age_Group_2" in out.columns and "Occupation_Group" in out.columns
    assert not {"Age_group", "Col", "MPI_Mean", "MPI_detail"} & set(out.columns)
    assert values(out, "ID", "City", "TOM", "BUMO", "BUMO_Previous", "IncomeBand") == [
        ("1", "Hanoi", "Independent Cafe", "B", "Unknown", "Under 3 millions VND"),
        ("3", "Hue", "A", "B", "P", "given"),
        ("4", "Hue", "A", "B", "P", "Unknown"),
    ]


def test_needstates_and_their_groups(spark):
    rows = [
        (1, "Socialzing", " Relaxing & entertainment", "Morning"), (1, "Socialzing", " Relaxing & entertainment", "Morning"),
        (int("9" * 18), "Other", "Studying & Others", "Noon"), (3, "Unmapped", "x", "Noon"),
    ]
    df = spark.createDataFrame(rows, "ID long, Needstates string, NeedstateGroup string, `Day#Daypart` string")
    out = cleaners.clean_needstates(df)
    assert out.count() == 3 and "Daypart" in out.columns
    wrong = t.mapping_mismatches(out, "Needstates", "NeedstateGroup", fixed.NEEDSTATE_GROUPS)
    assert sorted(values(wrong, "ID", "MappedGroup"), key=str) == [("1", "Socializing"), ("3", None)]
    long_id = spark.createDataFrame([("1" * 20,), ("1" * 21,)], "ID string")
    assert t.short_keys_only(long_id).count() == 1


def test_segmentation_and_image_cleaners(spark):
    seg = spark.createDataFrame([(1, 2, "Indepentdent ", "s "), (1, 1, "A", "t")], "ID long, n int, Brand string, Segmentation string")
    assert values(cleaners.clean_segmentation(seg, ["n"]), "ID", "Brand", "Segmentation") == [("1", "A", "t")]
    assert values(cleaners.clean_segmentation(seg, [-F.col("n")]), "Brand") == [("Independent",)]
    img = spark.createDataFrame([(1, None, " x "), (1, None, " x ")], "ID long, Awareness string, BrandImage string")
    assert values(cleaners.clean_brand_image(img, FOCAL), "Awareness", "BrandImage") == [(FOCAL, "x")]


@pytest.mark.parametrize("parts", [1, 7])
def test_keep_first_and_last(spark, parts):
    rows = [("a", i, f"v{i}") for i in range(100)] + [("b", 5, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(parts)
    assert sorted(values(t.keep_first(df, ["k"], ["n"]), "k", "v")) == [("a", "v0"), ("b", None)]
    assert dict(values(t.keep_last(df, ["k"], ["n"]), "k", "v"))["a"] == "v99"


def survey(spark):
    key = "ID long, City string, Year int"
    base = spark.createDataFrame(
        [(1, "X", 2017, 30.0, "Unknown"), (2, "X", 2017, None, "b"), (1, "X", 2018, 31.0, "b")], f"{key}, Age double, IncomeBand string"
    )
    need = spark.createDataFrame([(1, "X", 2017, "second", 2), (1, "X", 2017, "first", 1)], f"{key}, Needstates string, _n int")
    bh = spark.createDataFrame([(1, "X", 2017, "Aw", "Tr", 5.0, 9.0, 1.0)], f"{key}, Awareness string, Trial string, PPA double, Spending double, Frequency_Visit double")
    bi = spark.createDataFrame([(1, "X", 2017, "Bi", "at")], f"{key}, Awareness string, Attribute string")
    sg = spark.createDataFrame([(1, 3, 30.0, 10.0), (1, 4, 40.0, 10.0)], "ID long, Visit int, Spending double, PPA double")
    return {"sa_var": base, "needstate": need, "brandhealth": bh, "brand_image": bi, "segmentation": sg}


ORDER = {"needstate": ["_n"], "brandhealth": ["Awareness"], "brand_image": ["Attribute"], "segmentation": ["Visit"]}


def test_integration_keeps_one_row_per_respondent(spark):
    out = integrate(survey(spark), 2017, ORDER).orderBy("ID")
    rows = out.collect()
    assert len(rows) == 2 and "IncomeBand" not in out.columns and "_n" not in out.columns
    assert rows[0]["Needstates"] == "first" and rows[0]["Awareness"] == "Bi" and rows[0]["Visit"] == 3
    assert rows[1]["Trial"] == "Unknown" and rows[1]["Age"] == -1 and rows[1]["Spending"] == -1
    assert integrate(survey(spark), 2017, ORDER, dedup_segmentation=False).count() == 3


def test_integration_names_missing_columns(spark):
    parts = survey(spark)
    with pytest.raises(ValueError, match="brandhealth.*City"):
        integrate({**parts, "brandhealth": parts["brandhealth"].drop("City")}, 2017, ORDER)
    with pytest.raises(ValueError, match="segmentation.*Visit"):
        integrate({**parts, "segmentation": parts["segmentation"].drop("Visit")}, 2017, ORDER)
    with pytest.raises(ValueError, match="nope"):
        t.select_columns(parts["sa_var"], ["nope"])


def test_labels_attach_by_key_only_when_complete(spark):
    df = spark.createDataFrame([(1,), (2,)], "ID long")
    labels = spark.createDataFrame([(2, 0), (1, 1)], "ID long, cluster int")
    assert sorted(values(t.attach_labels(df, labels, "ID"), "ID", "cluster")) == [(1, 1), (2, 0)]
    with pytest.raises(ValueError):
        t.attach_labels(df, labels.where("ID = 1"), "ID")
    with pytest.raises(ValueError):
        t.attach_labels(df.where("ID = 1"), labels, "ID")


def test_brand_features(spark):
    spec = BrandSpec(FOCAL, [FOCAL, "B"])
    columns = ["TOM", "BUMO", "BUMO_Previous", "MostFavourite", "Awareness", "Spontaneous", "Trial", "P3M", "P1M", "Weekly", "Daily", "Needstates"]
    rows = [
        (FOCAL, FOCAL, FOCAL, FOCAL, *[FOCAL] * 7, "DRINKING tea"),
        ("z", "y", "B", "w", None, FOCAL, FOCAL, None, "x", None, None, None),
    ]
    out = build_features(spark.createDataFrame(rows, ", ".join(f"{x} string" for x in columns)), spec).collect()
    a, b = (r.asDict() for r in out)
    assert (a["Brand_Loyalty"], a["Brand_Switcher"], a["Funnel_Depth"], a["Awareness_Usage_Gap"], a["Need_is_Drinking"]) == (4, 0, 7, 0, 1)
    assert (b["TOM_Group"], b["BUMO_Previous_Group"]) == ("Others", "B")
    # both groups are Others: one agreement; the raw favourite is neither
    assert (b["Brand_Loyalty"], b["Brand_Switcher"], b["Funnel_Depth"], b["Awareness_Usage_Gap"], b["Need_is_Drinking"]) == (1, 1, 2, -1, 0)


def test_winsorized_range_equals_the_quantiles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "x double")
    out = [r["x"] for r in winsorize(df, ["x"], 0.1, 0.9).collect()]
    known = [x for x in out if x is not None]
    assert out.count(None) == 1 and min(known) == 10 and max(known) == 90


def test_standardized_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    out = standardized(df, ["a", "b"])
    row = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("b"), F.min("b")).first()
    assert row[0] == pytest.approx(0) and row[1] == pytest.approx(1) and row[2] == row[3] == 0


def test_raw_tables_to_encoded_features(spark):
    """The five raw tables through cleaning, integration, features and encoding."""
    from segspark.operators.encode import FeatureEncoder, FeatureSpec

    key = dict(City="X", Year=2017)
    raw = {
        "sa_var": spark.createDataFrame(
            [(i, "X ", 2017, 2.0, 20.0 + i, FOCAL, "B", FOCAL, None, "20 - 24 y.o.") for i in (1, 2, 3)],
            "ID long, City string, Year int, Group_size double, Age double, TOM string, BUMO string, "
            "MostFavourite string, BUMO_Previous string, `Age#Group#2` string",
        ),
        "needstate": spark.createDataFrame([(1, "X", 2017, "Drinking tea", "Noon", 1)], "ID long, City string, Year int, Needstates string, `Day#Daypart` string, _n int"),
        "brandhealth": health(
            spark, dict(ID=1, Awareness=FOCAL, Trial=FOCAL, Spending=30000.0, PPA=1.0, **{"Fre#visit": 2.0}, **key), dict(ID=2, **key)
        ),
        "brand_image": spark.createDataFrame([(1, "X", 2017, None, "at", "Img")], "ID long, City string, Year int, Awareness string, Attribute string, BrandImage string"),
        "segmentation": spark.createDataFrame([(1, 2, 30.0, 15.0, "B")], "ID long, Visit int, Spending double, PPA double, Brand string"),
    }
    clean = cleaners.clean_all(raw, FOCAL, ["Visit"], ["Attribute"])
    wide = integrate(clean, 2017, {**ORDER, "brandhealth": ["Brand"]})
    featured = build_features(wide, BrandSpec(FOCAL, [FOCAL])).cache()
    rows = {r["ID"]: r for r in featured.collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"]["Awareness"] == FOCAL and rows["1"]["Trial_flag"] == 1 and rows["1"]["Need_is_Drinking"] == 1
    assert rows["2"]["Awareness"] == "Unknown" and rows["3"]["Trial"] == "Unknown" and rows["3"]["Visit"] == -1
    model = FeatureEncoder(
        FeatureSpec(log_numeric=["Visit", "PPA"], numeric=["Age", "Funnel_Depth"], categorical=["Needstates"],
                    ordinal={"Age_Group_2": fixed.AGE_GROUP_ORDER})
    ).fit(featured)
    assert model.feature_names() == ["Visit", "PPA", "Age", "Funnel_Depth", "Age_Group_2", "Needstates_Unknown"]
    assert model.transform(featured, ["ID"]).where("ID = '3'").first()["Needstates_Unknown"] == 1.0


def test_spontaneous_is_evidence_without_awareness(spark):
    rows = [(None, FOCAL, FOCAL), (None, FOCAL, "Other"), (None, FOCAL, None)]
    df = spark.createDataFrame(rows, "Trial string, P3M string, Spontaneous string")
    assert [r["Trial"] for r in cleaners.fill_funnel(df, FOCAL).collect()] == [FOCAL, fixed.UNKNOWN, fixed.UNKNOWN]


def test_health_cleaner_leaves_out_what_is_absent(spark):
    base = spark.createDataFrame([("1", "a", 10.0), ("2", "a", 70000.0)], "ID string, Awareness string, Spending double")
    out = {r["ID"]: r for r in cleaners.clean_brandhealth(base, FOCAL).collect()}
    assert out["1"]["Segmentation"] != out["2"]["Segmentation"]
    assert out["1"]["NPS_P3M"] is None and out["1"]["NPS_P3M_Group"] == "Detractive"
    assert "Brand_Likability" not in out["1"].asDict() and "PPA" not in out["1"].asDict()
    for absent in ("Spending", "PPA", "Trial", "Brand_Likability", "Frequency_Visit", "NPS_P3M"):
        full = spark.createDataFrame(
            [("1", "a", "x", None, 5.0, 40000.0, 3.0, 7.0)],
            "ID string, Awareness string, Trial string, Brand_Likability string, Frequency_Visit double, Spending double, PPA double, NPS_P3M double",
        )
        assert cleaners.clean_brandhealth(full.drop(absent), FOCAL).count() == 1
