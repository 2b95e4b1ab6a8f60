"""Column contracts: transactions, score requests and the model's feature vector."""
from __future__ import annotations

from pyspark.sql import types as T

LABEL = "is_fraud"

# Source columns of a card transaction file, in file order.
TRANSACTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("trans_date_trans_time", T.TimestampNTZType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.LongType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.DateType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# Columns that never enter a model.
NOT_MODELLED = [
    "id", "trans_date_trans_time", "cc_num", "merchant", "first", "last", "street", "city",
    "state", "zip", "lat", "long", "job", "dob", "trans_num", "unix_time", "merch_lat",
    "merch_long", "trans_day", "distance_km", "quarter", "trans_weekday",
]

# The model's features, in training order.
FEATURES = [
    "category", "amt", "gender", "city_pop", "trans_month", "trans_hour", "is_weekend",
    "is_night", "is_business_hours", "is_holiday_season", "is_tax_season", "hour_sin",
    "hour_cos", "month_sin", "month_cos", "age", "age_group", "gender_encoded",
    "city_pop_category", "is_distant_transaction",
]

# The smaller exploratory vector before its category dummies are added.
COMPACT_FEATURES = [
    "amt", "gender", "city_pop", "trans_month", "trans_hour", "is_weekend", "age",
]

#: Features that reach the model as label codes.
CATEGORICAL = ["category", "gender", "age_group", "city_pop_category"]

# Score-request fields; five are required, the rest default to zero.
REQUEST = T.StructType([
    T.StructField("amt", T.DoubleType(), False),
    T.StructField("trans_hour", T.IntegerType(), False),
    T.StructField("trans_month", T.IntegerType(), False),
    T.StructField("age", T.IntegerType(), False),
    T.StructField("city_pop", T.LongType(), False),
    T.StructField("is_weekend", T.IntegerType()),
    T.StructField("is_night", T.IntegerType()),
    T.StructField("is_business_hours", T.IntegerType()),
    T.StructField("is_holiday_season", T.IntegerType()),
    T.StructField("is_tax_season", T.IntegerType()),
    T.StructField("hour_sin", T.DoubleType()),
    T.StructField("hour_cos", T.DoubleType()),
    T.StructField("month_sin", T.DoubleType()),
    T.StructField("month_cos", T.DoubleType()),
    T.StructField("gender_encoded", T.IntegerType()),
    T.StructField("is_distant_transaction", T.IntegerType()),
    T.StructField("city_pop_category", T.IntegerType()),
    T.StructField("age_group", T.IntegerType()),
    T.StructField("category", T.IntegerType()),
])
REQUEST_DEFAULTS = {f.name: 0 for f in REQUEST if f.nullable}
