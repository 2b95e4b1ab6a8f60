"""Feature expressions.

Every feature is stated once, as a Spark SQL expression. The DataFrame functions below and the
persisted pipeline in ``plans.pipeline`` both read these tables, so batch, streaming and served
features cannot drift apart. Each group is a list of layers; a layer may use columns of the
layers before it. All of it stays inside whole-stage code generation.
"""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

Layers = list[dict[str, str]]

# Bin edges are right-closed, the labels belong to the interval ending at the edge.
AGE_BINS = [(0, 18, "minor"), (18, 25, "young_adult"), (25, 35, "adult"),
            (35, 50, "middle_aged"), (50, 65, "senior"), (65, 100, "elderly")]
CITY_BINS = [(0, 10000, "rural"), (10000, 50000, "small_town"), (50000, 100000, "town"),
             (100000, 500000, "small_city"), (500000, 1000000, "city"),
             (1000000, None, "major_city")]
CITY_GROUP_LABELS = ["<10k", "10k-50k", "50k-100k", "100k-500k", "500k-1M", "1M+"]
PERIODS = ["morning", "afternoon", "evening", "midnight"]
AGE_BAND_LABELS = ["minor", "young adult", "adult", "senior"]
REFERENCE_DATE = "2021-01-01"
DAYS_PER_YEAR = 365
EARTH_RADIUS_KM = 6371
DISTANT_KM = 100
RISK_MEDIUM, RISK_HIGH = 0.3, 0.7
SCORE_WEIGHTS = {"recall": 0.4, "f1": 0.4, "auc": 0.2}

# State to region, as the exploratory analysis assigns it (all others are West).
REGIONS = {
    "Midwest": ["IA", "KS", "MN", "MO", "NE", "ND", "SD"],
    "Northeast": ["CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"],
    "South": ["DE", "FL", "GA", "MD", "NC", "SC", "VA", "DC", "WV", "AL", "KY", "MS", "TN",
              "AR", "LA", "OK", "TX"],
}
# The census assignment puts five more states into the Midwest.
CENSUS_REGIONS = {**REGIONS, "Midwest": REGIONS["Midwest"] + ["IL", "IN", "MI", "OH", "WI"]}


def one_of(column: str, values) -> str:
    """0/1 membership flag; null counts as absent."""
    listed = ", ".join(str(v) for v in values)
    return f"CAST(coalesce({column} IN ({listed}), false) AS INT)"


def right_closed(column: str, bins) -> str:
    """Label of the interval (low, high] holding the value, null outside all of them."""
    arms = []
    for low, high, label in bins:
        upper = "" if high is None else f" AND {column} <= {high}"
        arms.append(f"WHEN {column} > {low}{upper} THEN '{label}'")
    return f"CASE {' '.join(arms)} END"


def age_years(dob: str, on: str = REFERENCE_DATE) -> str:
    """Whole years of 365 days, rounded down also before birth."""
    return f"CAST(floor(datediff(DATE'{on}', {dob}) / {DAYS_PER_YEAR}.0e0) AS INT)"


def cyclic(function: str, column: str, period: int) -> str:
    return f"{function}(2 * pi() * {column} / {period})"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance; null and NaN inputs stay null and NaN.

    The arc is taken with atan2, which unlike asin has no domain to leave at antipodal points.
    """
    chord = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return (
        f"2.0e0 * {EARTH_RADIUS_KM} * atan2(sqrt({chord}), sqrt(greatest(0.0e0, 1.0e0 - ({chord}))))"
    )


def region_of(state: str, regions=None) -> str:
    arms = " ".join(
        "WHEN {} IN ({}) THEN '{}'".format(state, ", ".join(f"'{s}'" for s in states), name)
        for name, states in (regions or REGIONS).items()
    )
    return f"CASE {arms} ELSE 'West' END"


TEMPORAL: Layers = [
    {
        "trans_month": "month(trans_date_trans_time)",
        "trans_day": "date_format(trans_date_trans_time, 'EEEE')",
        "trans_hour": "hour(trans_date_trans_time)",
        "trans_weekday": "weekday(trans_date_trans_time)",
        "quarter": "quarter(trans_date_trans_time)",
    },
    {
        "is_weekend": one_of("trans_weekday", [5, 6]),
        "is_night": one_of("trans_hour", [22, 23, 0, 1, 2, 3, 4, 5]),
        "is_business_hours": one_of("trans_hour", range(9, 17)),
        "is_holiday_season": one_of("trans_month", [11, 12]),
        "is_tax_season": one_of("trans_month", [1, 2, 3, 4]),
        "hour_sin": cyclic("sin", "trans_hour", 24),
        "hour_cos": cyclic("cos", "trans_hour", 24),
        "month_sin": cyclic("sin", "trans_month", 12),
        "month_cos": cyclic("cos", "trans_month", 12),
    },
]

DEMOGRAPHIC: Layers = [
    {
        "age": age_years("dob"),
        "gender_encoded": "CASE gender WHEN 'M' THEN 1 WHEN 'F' THEN 0 END",
    },
    {"age_group": right_closed("age", AGE_BINS)},
]

GEOGRAPHIC: Layers = [
    {
        "city_pop_category": right_closed("city_pop", CITY_BINS),
        "distance_km": haversine_km("lat", "long", "merch_lat", "merch_long"),
    },
    {
        "is_distant_transaction":
            f"CASE WHEN distance_km > {DISTANT_KM} AND NOT isnan(distance_km) THEN 1 ELSE 0 END",
    },
]

#: Columns only the exploratory reports use; they build on TEMPORAL and DEMOGRAPHIC.
EXPLORATORY: Layers = [
    {
        "period_of_day": "CASE WHEN trans_hour >= 6 AND trans_hour < 12 THEN 'morning' "
                         "WHEN trans_hour >= 12 AND trans_hour < 18 THEN 'afternoon' "
                         "WHEN trans_hour >= 18 AND trans_hour < 24 THEN 'evening' "
                         "ELSE 'midnight' END",
        "age_band": "CASE WHEN age >= 0 AND age < 18 THEN 'minor' "
                    "WHEN age >= 18 AND age < 30 THEN 'young adult' "
                    "WHEN age >= 30 AND age < 50 THEN 'adult' ELSE 'senior' END",
        "gender_flag": "CASE WHEN gender = 'M' THEN 1 ELSE 0 END",
        "city_pop_group": right_closed(
            "city_pop",
            [(low, high, label) for (low, high, _), label in zip(CITY_BINS, CITY_GROUP_LABELS)],
        ),
        "state_region": region_of("state"),
    },
]


def add_layers(df: DataFrame, layers: Layers) -> DataFrame:
    for layer in layers:
        df = df.withColumns({name: F.expr(sql) for name, sql in layer.items()})
    return df


def add_temporal(df: DataFrame) -> DataFrame:
    return add_layers(df, TEMPORAL)


def add_demographic(df: DataFrame) -> DataFrame:
    return add_layers(df, DEMOGRAPHIC)


def add_geographic(df: DataFrame) -> DataFrame:
    return add_layers(df, GEOGRAPHIC)


def add_exploratory(df: DataFrame) -> DataFrame:
    return add_layers(df, EXPLORATORY)


def enrich(df: DataFrame) -> DataFrame:
    """All features of the modelling path."""
    return add_layers(df, TEMPORAL + DEMOGRAPHIC + GEOGRAPHIC)


def add_interactions(df: DataFrame, columns=("amt", "age", "trans_hour", "city_pop")) -> DataFrame:
    """Products of every pair of the numeric columns that are present."""
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "double")}
    present = [c for c in columns if c in numeric]
    return df.withColumns({
        f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in combinations(present, 2)
    })


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def linear_score(weights: dict[str, float], intercept: float = 0.0) -> Column:
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(name).cast("double")
    return total


def over_threshold(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= F.lit(float(threshold))).cast("int")


def risk_level(probability: Column, medium: float = RISK_MEDIUM, high: float = RISK_HIGH) -> Column:
    return (
        F.when(probability < medium, "LOW")
        .when(probability < high, "MEDIUM")
        .when(probability.isNotNull(), "HIGH")
    )


def composite_score(recall: Column, f1: Column, auc: Column, weights=None) -> Column:
    w = weights or SCORE_WEIGHTS
    return recall * w["recall"] + f1 * w["f1"] + auc * w["auc"]


def display_name(key: Column) -> Column:
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


def model_key(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def round_half_even(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column, halves to the even digit."""
    return df.withColumns({
        f.name: F.bround(F.col(f.name), digits)
        for f in df.schema if f.dataType.typeName() in ("double", "float")
    })
