import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cardwatch.functions import features as feat


def values(spark, rows, schema, expression):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.out for r in df.withColumn("out", F.expr(expression)).orderBy("i").collect()]


def test_age_groups_are_right_closed(spark):
    ages = [(a,) for a in (0, 1, 18, 19, 25, 26, 100, 101, -1, None)]
    assert values(spark, ages, "age int", feat.right_closed("age", feat.AGE_BINS)) == [
        None, "minor", "minor", "young_adult", "young_adult", "adult", "elderly", None, None, None]


def test_city_sizes(spark):
    sizes = [(c,) for c in (0, 1, 10000, 10001, 1000000, 1000001)]
    assert values(spark, sizes, "city_pop long", feat.right_closed("city_pop", feat.CITY_BINS)) == [
        None, "rural", "rural", "small_town", "city", "major_city"]


def test_age_rounds_down_before_birth(spark):
    born = [(dt.date(2020, 6, 1),), (dt.date(2021, 6, 1),), (dt.date(2000, 1, 1),)]
    assert values(spark, born, "dob date", feat.age_years("dob")) == [0, -1, 21]


def test_exploratory_columns(spark):
    rows = [(0, -1, "M", "AL"), (6, 0, "F", "NY"), (12, 18, None, "IL"), (18, 30, "X", "IA"),
            (23, 50, "M", "CA")]
    df = spark.createDataFrame(
        [(i, *r, 10) for i, r in enumerate(rows)],
        "i int, trans_hour int, age int, gender string, state string, city_pop long")
    out = feat.add_exploratory(df).orderBy("i").collect()
    assert [r.period_of_day for r in out] == ["midnight", "morning", "afternoon", "evening", "evening"]
    assert [r.age_band for r in out] == ["senior", "minor", "young adult", "adult", "senior"]
    assert [r.gender_flag for r in out] == [1, 0, 0, 0, 1]
    assert [r.state_region for r in out] == ["South", "Northeast", "West", "Midwest", "West"]
    assert {r.city_pop_group for r in out} == {"<10k"}
    assert values(spark, [("IL",)], "state string", feat.region_of("state", feat.CENSUS_REGIONS)) == ["Midwest"]


def test_hours_and_seasons(spark):
    hours = [5, 6, 8, 9, 16, 17, 21, 22]
    df = spark.createDataFrame(
        [(i, dt.datetime(2020, 1 + i, 6, h, 30)) for i, h in enumerate(hours)],
        "i int, trans_date_trans_time timestamp_ntz")
    out = feat.add_temporal(df).orderBy("i").collect()
    assert [r.is_night for r in out] == [1, 0, 0, 0, 0, 0, 0, 1]
    assert [r.is_business_hours for r in out] == [0, 0, 0, 1, 1, 0, 0, 0]
    assert [r.is_tax_season for r in out] == [1, 1, 1, 1, 0, 0, 0, 0]
    assert out[0].trans_day == "Monday" and out[0].trans_weekday == 0
    assert [r.quarter for r in out] == [1, 1, 1, 2, 2, 2, 3, 3]
    assert out[0].hour_sin == pytest.approx(math.sin(2 * math.pi * 5 / 24))


def test_gender_code_keeps_unknown_as_null(spark):
    sql = feat.DEMOGRAPHIC[0]["gender_encoded"]
    assert values(spark, [("M",), ("F",), (None,), ("X",)], "gender string", sql) == [1, 0, None, None]


def test_distance(spark):
    df = spark.createDataFrame(
        [(0, 10.0, 20.0, 10.0, 20.0), (1, 0.0, 0.0, 0.0, 180.0), (2, float("nan"), 0.0, 0.0, 0.0),
         (3, None, 0.0, 0.0, 0.0)],
        "i int, lat double, long double, merch_lat double, merch_long double"
    ).withColumn("city_pop", F.lit(1))
    out = feat.add_geographic(df).orderBy("i").collect()
    assert out[0].distance_km == 0
    assert out[1].distance_km == pytest.approx(math.pi * 6371)
    assert [r.is_distant_transaction for r in out] == [0, 1, 0, 0]


def test_risk_bands(spark):
    p = [(x,) for x in (0.0, 0.2999, 0.3, 0.6999, 0.7, 1.0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(p)], "i int, p double")
    out = df.withColumn("r", feat.risk_level(F.col("p"))).orderBy("i").collect()
    assert [r.r for r in out] == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None]


def test_interactions_names_and_half_even(spark):
    df = spark.createDataFrame([(2.0, 3, 4, 5)], "amt double, age int, trans_hour int, city_pop long")
    row = feat.add_interactions(df).first()
    assert row.amt_x_age == 6.0 and row.trans_hour_x_city_pop == 20
    rounded = feat.round_half_even(spark.createDataFrame([(2.5, 3.5)], "a double, b double"), 0).first()
    assert (rounded.a, rounded.b) == (2.0, 4.0)
