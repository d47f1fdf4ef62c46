from pyspark.sql import functions as F

from courtstats.functions import columns as C
from courtstats.schemas import SITUATION_EDGES, SITUATION_LABELS


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_to_number_is_lenient_about_bad_text(spark):
    df = spark.createDataFrame(
        [("105",), ("",), (None,), (" 7 ",), ("12d",), ("0x1",), ("nan",), ("1e2",), ("-3.5",)], "s string"
    )
    assert values(df, C.to_number(F.col("s"))) == [105.0, None, None, 7.0, None, None, None, 100.0, -3.5]


def test_to_number_strict_raises(spark):
    df = spark.createDataFrame([("105",), ("x",)], "s string")
    try:
        values(df, C.to_number(F.col("s"), "raise"))
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    else:
        raise AssertionError("bad text must fail")


def test_cut_is_right_closed(spark):
    leads = [-100, -99, -15, -14, -6, -5, 6, 7, 15, 16, 100, 101]
    df = spark.createDataFrame([(v,) for v in leads], "x int")
    big_d, mod_d, close, mod_l, big_l = SITUATION_LABELS
    assert values(df, C.cut(F.col("x"), SITUATION_EDGES, SITUATION_LABELS)) == [
        None, big_d, big_d, mod_d, mod_d, close, close, mod_l, mod_l, big_l, big_l, None,
    ]


def test_parse_minutes(spark):
    df = spark.createDataFrame(
        [("2:31", 9.0), ("0:05", 9.0), ("12", 9.0), ("", 2.5), (None, 1.5), ("x", None)], "s string, alt double"
    )
    got = values(df, C.parse_minutes(F.col("s"), F.col("alt")))
    assert [None if v is None else round(v, 4) for v in got] == [2.5167, 0.0833, 12.0, 2.5, 1.5, None]


def test_decode_season(spark):
    df = spark.createDataFrame([("12023",), ("22024",), ("42024",), ("52024",), ("92024",)], "s string")
    got = df.select(C.decode_season(F.col("s")).alias("d")).select("d.*").collect()
    assert [tuple(r) for r in got] == [
        ("preseason", 2023), ("regular", 2024), ("playoffs", 2024), ("playin", 2024), (None, 2024),
    ]


def test_dates_flags_and_text(spark):
    df = spark.createDataFrame([("2023-10-25T00:00:00", 1.25), ("bad", -0.5)], "d string, v double")
    assert [str(v) for v in values(df, C.iso_date(F.col("d")))] == ["2023-10-25", "None"]
    assert values(df, C.sign_flag(F.col("v"))) == ["win", "loss"]
    assert values(df, C.format_number(F.col("v"), 2, signed=True)) == ["+1.25", "-0.50"]
    assert values(df, C.label_if(F.col("v"), 1.0, "Linear", "Complex")) == ["Complex", "Linear"]


def test_argmax_name_takes_first_on_ties_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0, 3.0), (None, 2.0, 1.0), (None, None, None)], "a double, b double, c double"
    )
    assert values(df, C.argmax_name(["a", "b", "c"])) == ["b", "b", None]
    assert values(df, C.argmin_name(["a", "b", "c"])) == ["a", "c", None]


def test_rounded_has_no_negative_zero(spark):
    df = spark.createDataFrame([(-0.00001,), (1.23456,)], "v double")
    assert [repr(v) for v in values(df, C.rounded(F.col("v"), 4))] == ["0.0", "1.2346"]
