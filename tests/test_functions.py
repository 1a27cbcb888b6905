from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.functions import numeric, text


def test_rounding_is_half_away_from_zero(spark):
    values = [0.125, -0.125, 2.675, 1.005, 1234.565, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(numeric.round_half_up(F.col("v"), 2)).collect()]
    want = [None if v is None else float(Decimal(str(v)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert got == want
    ints = spark.createDataFrame([(0.5,), (1.5,), (-2.5,), (None,)], "v double")
    assert [r[0] for r in ints.select(numeric.round_to_int(F.col("v"))).collect()] == [1, 2, -3, None]


def test_missing_values_floor_to_zero(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "v double")
    assert [r[0] for r in df.select(numeric.floor_zero(F.col("v"))).collect()] == [0.0, 0.0, 2.0]


def test_recycling_rate_clamps_and_defaults(spark):
    data = [(100, 40), (100, 140), (100, -50), (0, 5), (None, 5), (5, None)]
    df = spark.createDataFrame(data, "r long, a long")
    got = [r[0] for r in df.select(numeric.recycling_rate(F.col("r"), F.col("a"))).collect()]
    assert got == [0.6, 0.0, 1.0, 0.0, 0.0, 0.0]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 1000)), min_size=1, max_size=30))
def test_wrap_delta_stays_within_one_turn(spark, pairs):
    df = spark.createDataFrame([(a / 10, b / 10) for a, b in pairs], "cur double, prev double")
    for cur, prev, step in df.select("cur", "prev", numeric.wrap_delta(F.col("cur"), F.col("prev"))).collect():
        assert 0 <= step <= 100
        assert abs(step - (cur - prev if cur >= prev else cur + 100 - prev)) < 1e-9


def test_email_normalisation(spark):
    df = spark.createDataFrame([(" A@x.Y;b@x.y,, a@X.y ;",), (None,), (" ; ",)], "raw string")
    got = df.select(text.normalize_emails(F.col("raw")).alias("l")).select("l", text.emails_csv(F.col("l"))).collect()
    assert [tuple(r) for r in got] == [(["a@x.y", "b@x.y"], "a@x.y,b@x.y"), ([], None), ([], None)]
    items = spark.createDataFrame([([" B@x ", None, "b@X", "c"],)], "l array<string>")
    assert items.select(text.normalize_email_items(F.col("l"))).first()[0] == ["b@x", "c"]
    one = spark.createDataFrame([("  ",), (" Q@r ",), (None,)], "e string")
    assert [r[0] for r in one.select(text.norm_email(F.col("e"))).collect()] == [None, "q@r", None]
