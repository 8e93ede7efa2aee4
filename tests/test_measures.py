import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.functions import measures as M
from ratingloom.functions import text as X


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row[0] if len(row) == 1 else row


def wilson(p, n, z=1.959963984540054):
    share = p / n
    spread = z * math.sqrt((share * (1 - share) + z * z / (4 * n)) / n)
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def wilson_rows(spark, pairs, **options):
    df = spark.createDataFrame(pairs, "p bigint, n bigint")
    return [r[0] for r in df.select(M.wilson_lower_bound("p", "n", **options)).collect()]


def test_wilson_published_value(spark):
    (score,) = wilson_rows(spark, [(138220, 140111)])
    assert round(score * 100, 2) == 98.59
    assert score == pytest.approx(0.98588589, abs=1e-8)


def test_wilson_without_evidence(spark):
    pairs = [(None, 10), (5, None), (0, 0), (3, -1), (0, 7)]
    assert wilson_rows(spark, pairs)[:4] == [None] * 4
    assert wilson_rows(spark, pairs)[4] == pytest.approx(0.0, abs=1e-12)
    assert wilson_rows(spark, pairs, zero_positive="null") == [None] * 5
    with pytest.raises(ValueError):
        M.wilson_lower_bound("p", "n", zero_positive="maybe")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=60))
def test_wilson_properties(spark, drawn):
    pairs = [(min(p, n), n) for p, n in drawn]
    for (p, n), score in zip(pairs, wilson_rows(spark, pairs)):
        assert score == pytest.approx(wilson(p, n), rel=1e-12, abs=1e-12)
        assert -1e-12 <= score <= p / n + 1e-12


def test_wilson_monotone(spark):
    rising_hits = wilson_rows(spark, [(p, 40) for p in range(41)])
    assert rising_hits == sorted(rising_hits)
    rising_evidence = wilson_rows(spark, [(3 * k, 4 * k) for k in range(1, 60)])
    assert rising_evidence == sorted(rising_evidence)


def test_counts_and_rates(spark):
    df = spark.createDataFrame([(None,), (-5,), (0,), (7,)], "c bigint")
    assert [r[0] for r in df.select(M.non_negative("c")).collect()] == [0, 0, 0, 7]
    rates = spark.createDataFrame([(1, 4), (0, 0), (0, 3), (1, None)], "p bigint, n bigint")
    assert [r[0] for r in rates.select(M.rating_pct("p", "n")).collect()] == [25.0, None, 0.0, None]


def test_price_rules(spark):
    prices = [(None,), (0.0,), (0.01,), (4.99,), (5.0,), (9.99,), (10.0,), (20.0,), (40.0,), (-1.0,)]
    df = spark.createDataFrame(prices, "price double").withColumn("price", M.valid_price("price"))
    bands = [r[0] for r in df.select(M.price_band("price")).collect()]
    assert bands == [
        "40+", "Free", "Under 5", "Under 5", "5-10", "5-10", "10-20", "20-40", "40+", "40+",
    ]
    assert [r[0] for r in df.select(M.price_band("price", null_band=None)).collect()][0] is None
    assert [r[0] for r in df.select(M.price_band("price", null_band="Unknown")).collect()][-1] == "Unknown"
    places = df.select(M.band_position(M.price_band("price", null_band="Unknown"))).collect()
    assert [r[0] for r in places] == [6, 0, 1, 1, 2, 2, 3, 4, 5, 6]


def test_owner_range(spark):
    owners = ["10-20", "10000-20000", "n/a", "", None, "5-x", "x-7", "99999999999999999999-1"]
    df = spark.createDataFrame([(o,) for o in owners], "o string")
    low, high = M.owner_lower("o"), M.owner_upper("o")
    rows = [tuple(r) for r in df.select(low, high, M.midpoint(low, high)).collect()]
    assert rows == [
        (10, 20, 15.0),
        (10000, 20000, 15000.0),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (5, None, None),
        (None, 7, None),
        (None, 1, None),
    ]


def test_missing_any(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(M.missing_any("a", "b")).collect()] == [False, True, True]


def test_relative_size(spark):
    assert one(spark, s=M.relative_size(F.lit(25.0), F.lit(100.0))) == 80 + 520 * 0.5


@pytest.mark.parametrize(
    "text, number",
    [("12", 12.0), (" 1e3 ", 1000.0), ("-0.5", -0.5), ("12f", None), ("1.d", None), ("", None),
     ("free", None), (None, None)],
)
def test_to_number(spark, text, number):
    assert one(spark, n=X.to_number(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(
    "text, date",
    [("2019-02-28", "2019-02-28"), ("2019-02-30", None), ("28/02/2019", None), ("", None), (None, None)],
)
def test_to_date(spark, text, date):
    found = one(spark, d=X.to_date(F.lit(text).cast("string")))
    assert (str(found) if found else None) == date


@pytest.mark.parametrize(
    "text, label, table_label",
    [
        ("Anvil 2", "Anvil 2", "Anvil 2"),
        ("東方 ～ Bright Star.", "Bright Star", "Bright Star"),
        ("東方", "App 東方", "Non-Latin title"),
        (" ~-. ", "App  ~-. ", "Non-Latin title"),
        ("naïve", "nave", "nave"),
    ],
)
def test_display_label(spark, text, label, table_label):
    row = one(spark, a=X.display_label(F.lit(text)), b=X.display_label(F.lit(text), "Non-Latin title"))
    assert tuple(row) == (label, table_label)


@pytest.mark.parametrize("tag", ["2d", "free_to_play", "co-op", "rts", "1980s", "e_sports", "3d_vision"])
def test_title_words_equal_title_case(spark, tag):
    assert one(spark, t=X.title_words(F.lit(tag))) == tag.replace("_", " ").title()


def test_number_texts(spark):
    row = one(
        spark,
        a=X.thousands(F.lit(32803682)),
        b=X.affixed(F.lit(82.5), suffix="%"),
        c=X.affixed(F.lit(3), prefix="GBP "),
    )
    assert tuple(row) == ("32,803,682", "82.50%", "GBP 3.00")


def test_split_labels(spark):
    text = " Action;; Indie ;Action; ;RPG;"
    assert one(spark, l=X.split_labels(F.lit(text))) == ["Action", "Indie", "RPG"]
    for separator in ("|", "$", "\\", "||", "a.b"):
        joined = separator.join(["a", " b c ", "", "a", "  "])
        assert one(spark, l=X.split_labels(F.lit(joined), separator)) == ["a", "b c"]
    assert one(spark, l=X.split_labels(F.lit("  "))) == []
    for wrong in ("", ", ", " "):
        with pytest.raises(ValueError):
            X.split_labels("text", wrong)
    assert one(spark, l=X.split_labels(F.lit(None).cast("string"))) is None


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab ;é", max_size=14), min_size=1, max_size=60))
def test_split_labels_by_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r["i"]: r["l"] for r in df.select("i", X.split_labels("t").alias("l")).collect()}
    for i, text in enumerate(texts):
        labels = [part.strip(" ") for part in text.split(";")]
        assert found[i] == list(dict.fromkeys(label for label in labels if label))


def test_trimming(spark):
    text = F.lit("\t a b \n")
    assert one(spark, t=X.trimmed(text)) == "\t a b \n"
    assert one(spark, t=X.trimmed(text, whitespace=True)) == "a b"
