"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cardwatch.functions import checks, features as feat
from cardwatch.operators import (
    boosting, eda, encode, evaluate, exacttree, explain, gradient, joins, knn, profile, project, ranking, resample,
)
from cardwatch.plans import boosted, pipeline, scoring, training
from cardwatch.schema import (
    CATEGORICAL, COMPACT_FEATURES, FEATURES, LABEL, NOT_MODELLED, TRANSACTION,
)
from cardwatch.session import scratch_path
from cardwatch.sources import files, store
from cardwatch.sources.tables import SCHEMAS, split_of, transactions
from cardwatch.streaming import score as stream

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

# Parameters the SQL texts share.
LINEAR = {"amt": 0.01, "age": 0.005, "trans_hour": 0.02, "is_night": 0.3}
LINEAR_INTERCEPT = -4.5
NEIGHBOUR_COLUMNS = ["amt", "trans_hour", "age", "city_pop"]
CORRELATED = [
    "amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud", "trans_month",
    "trans_hour", "trans_weekday", "quarter", "is_weekend", "is_night", "is_business_hours",
    "is_holiday_season", "is_tax_season", "age", "gender_encoded", "distance_km",
    "is_distant_transaction",
]
COLLINEAR = ["amt", "city_pop", "trans_month", "trans_hour", "trans_weekday", "is_weekend",
             "is_night", "age", "gender_encoded", "distance_km"]
THRESHOLDS = [0.1, 0.3, 0.5, 0.7, 0.9]
#: Columns of few values, so that every value can be a cut, and one round of boosting over them.
ROUND_COLUMNS = ["amt_band", "trans_hour", "trans_month", "trans_weekday", "is_weekend", "is_night", "gender_encoded"]
ROUND_PARAMS = {"learning_rate": 0.3, "reg_alpha": 2.0, "reg_lambda": 5.0, "min_child_weight": 1.0}
#: Columns of many values for the exact tree.
EXACT_COLUMNS = ["amt", "city_pop", "age", "trans_hour", "trans_month", "gender_encoded"]
ASCENT_BASE = ["amt", "gender_flag", "city_pop", "trans_month", "trans_hour", "is_weekend", "age"]


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating columns to fixed digits; adding zero turns -0.0 into 0.0."""
    return df.withColumns({
        f.name: F.round(F.col(f.name), digits) + F.lit(0.0)
        for f in df.schema if isinstance(f.dataType, T.DoubleType)
    })


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    view = transactions(spark, folder)
    return split_of(view, "train"), split_of(view, "test")


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    return feat.add_exploratory(feat.enrich(transactions(spark, folder)))


def _train(spark: SparkSession, folder: str) -> DataFrame:
    return split_of(_enriched(spark, folder), "train")


def _model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """id, split, label, model, score, prediction for three fixed formulas."""
    rows = feat.enrich(transactions(spark, folder))
    formulas = {
        "logistic_regression": (F.col("amt") - 420.0) / 25.0,
        "random_forest": (F.col("amt") - 400.0) / 60.0 + F.col("is_night") * 0.5,
        "gradient_boosting": (F.col("amt") - 430.0) / 15.0 + (F.col("trans_hour") - 12) / 24.0,
    }
    cells = F.array(*[
        F.struct(F.lit(m).alias("model"), F.round(feat.sigmoid(s), 6).alias("score"))
        for m, s in formulas.items()
    ])
    return rows.select("id", "split", F.col(LABEL).alias("label"), F.explode(cells).alias("c")).select(
        "id", "split", "label", "c.model", "c.score",
        feat.over_threshold(F.col("c.score")).alias("prediction"),
    )


def _one_score(spark: SparkSession, folder: str, model: str = "random_forest") -> DataFrame:
    return _model_scores(spark, folder).where(F.col("model") == model)


# --- sources ---------------------------------------------------------------------------------

@query
def s_load(spark, folder):
    """Written as a source file would be, and read back with the declared schema."""
    view = transactions(spark, folder)
    full = view.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in view.columns
        else F.lit(None).cast(f.dataType).alias(f.name) for f in TRANSACTION
    ])
    path = scratch_path(spark, "load")
    files.write_csv(full, path)
    return files.load_transactions(spark, path).select(
        *[c for c in view.columns if c != "split"]
    )


@query
def s_parse(spark, folder):
    """Timestamps and dates from text; every fiftieth text is broken on purpose."""
    raw = transactions(spark, folder).select(
        "id",
        F.expr("CASE WHEN id % 50 = 0 THEN 'not a time' ELSE "
               "date_format(trans_date_trans_time, 'yyyy-MM-dd HH:mm:ss') END")
        .alias("trans_date_trans_time"),
        F.expr("CASE WHEN id % 50 = 1 THEN '31.12.1999' ELSE date_format(dob, 'yyyy-MM-dd') END")
        .alias("dob"),
    )
    return files.parse_times(raw)


@query
def s_parse_failures(spark, folder):
    raw = transactions(spark, folder).select(
        "id",
        F.expr("CASE WHEN id % 50 = 0 THEN 'not a time' ELSE "
               "date_format(trans_date_trans_time, 'yyyy-MM-dd HH:mm:ss') END")
        .alias("trans_date_trans_time"),
        F.expr("CASE WHEN id % 70 = 1 THEN '31.12.1999' ELSE date_format(dob, 'yyyy-MM-dd') END")
        .alias("dob"),
    )
    return files.count_failures(raw, ["trans_date_trans_time"], ["dob"])


@query
def s_quarantine(spark, folder):
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("amt", T.DoubleType()),
        T.StructField("city_pop", T.LongType()),
    ])
    path = scratch_path(spark, "quarantine")
    transactions(spark, folder).select(
        F.col("id").cast("string"),
        F.expr("CASE WHEN id % 97 = 0 THEN 'bad' ELSE CAST(amt AS STRING) END").alias("amt"),
        F.expr("CASE WHEN id % 89 = 0 THEN 'many' ELSE CAST(city_pop AS STRING) END")
        .alias("city_pop"),
    ).write.option("header", True).csv(path)
    good, bad, _ = files.set_aside(files.read_checked(spark, path, schema), scratch_path(spark, "checked"), ["id"])
    return good.select("id", F.lit("good").alias("status"), "amt", "city_pop").unionByName(
        bad.select(
            F.split(files.CORRUPT, ",")[0].cast("bigint").alias("id"),
            F.lit("bad").alias("status"),
            F.lit(None).cast("double").alias("amt"), F.lit(None).cast("bigint").alias("city_pop"),
        )
    )


@query
def s_model_roundtrip(spark, folder):
    """A saved and loaded model gives every test row the score of the original."""
    train, test = _parts(spark, folder)
    model = training.train(training.KINDS["logistic_regression"], train)
    root = scratch_path(spark, "store")
    store.save_model(model, root, "r1", "logistic_regression")
    loaded = store.load_model(root, "r1", "logistic_regression")
    first = training.predictions(model, test).select("id", F.col("score").alias("a"))
    again = training.predictions(loaded, test).select("id", F.col("score").alias("b"))
    return first.join(again, "id").select("id", (F.col("a") == F.col("b")).alias("same"))


@query
def s_registry(spark, folder):
    """Two runs saved; the newest row per model with its metrics and description."""
    train, test = _parts(spark, folder)
    features = pipeline.fit_features(train)
    root = scratch_path(spark, "registry")
    for run, depth in (("run-1", 3), ("run-2", 6)):
        model = training.train(training.KINDS["decision_tree"], train, {"max_depth": depth},
                               features=features)
        results = evaluate.full_metrics(
            training.predictions(model, test).withColumn("model", F.lit("decision_tree"))
        )
        info = store.model_info(model, pipeline.MODEL_COLUMNS)
        store.write_summary(evaluate.comparison(results), {"decision_tree": info},
                            "decision_tree", root, run)
    return store.latest_runs(store.registry(spark, root)).drop("saved_at", "features")


@query
def s_registry_log(spark, folder):
    """Two runs of fixed formulas, the first one saved twice: the newest row per model, and its runs."""
    info = {"model_type": "formula", "num_features": len(FEATURES), "features": FEATURES[:10], "scaler_available": False}
    scores, root = _model_scores(spark, folder), scratch_path(spark, "registry")
    for run, part, models in (("run-1", "train", ["logistic_regression", "random_forest", "gradient_boosting"]),
                              ("run-2", "test", ["random_forest", "gradient_boosting"]),
                              ("run-1", "test", ["logistic_regression", "random_forest"])):
        results = evaluate.full_metrics(scores.where(F.col("model").isin(models) & (F.col("split") == part)))
        store.write_summary(evaluate.comparison(results), {m: info for m in models}, models[0], root, run)
    rows = store.registry(spark, root)
    runs = rows.groupBy("model").agg(F.count(F.lit(1)).alias("runs"))
    return rounded(store.latest_runs(rows).drop("saved_at", "features").join(runs, "model"))


@query
def s_summary(spark, folder):
    """Results of three fixed scores written as a run summary and read back."""
    results = evaluate.full_metrics(_model_scores(spark, folder).where("split = 'test'"))
    info = {"model_type": "formula", "num_features": len(FEATURES), "features": FEATURES[:10],
            "scaler_available": False}
    root = scratch_path(spark, "summary")
    best = evaluate.best_model(results).first()["model"]
    store.write_summary(
        evaluate.comparison(results),
        {m: info for m in ("logistic_regression", "random_forest", "gradient_boosting")},
        best, root, "run-1",
    )
    return rounded(store.registry(spark, root).drop("saved_at", "features"))


@query
def s_batch_score(spark, folder):
    path = scratch_path(spark, "scores")
    scored = scoring.score_linear(
        feat.enrich(transactions(spark, folder)), LINEAR, LINEAR_INTERCEPT
    )
    scoring.write_scores(scored, path)
    schema = "id bigint, is_fraud boolean, fraud_probability double, risk_level string"
    return rounded(spark.read.schema(schema).parquet(path))


# --- profiling -------------------------------------------------------------------------------

@query
def q_shape(spark, folder):
    train, test = _parts(spark, folder)
    return rounded(profile.shape({"train": train, "test": test}))


def _with_gaps(spark, folder):
    """The transactions with some values blanked, so that missing values can be counted."""
    return transactions(spark, folder).selectExpr(
        "id", "CASE WHEN id % 11 = 0 THEN NULL ELSE category END AS category",
        "CASE WHEN id % 13 = 0 THEN double('NaN') WHEN id % 17 = 0 THEN NULL ELSE amt END AS amt",
        "gender", "CASE WHEN id % 3 = 0 THEN NULL ELSE city_pop END AS city_pop", "is_fraud",
    )


@query
def q_missing(spark, folder):
    return profile.missing_counts(_with_gaps(spark, folder))


@query
def q_duplicates(spark, folder):
    """Copies of (card, category, gap-ridden state) among the transactions."""
    rows = transactions(spark, folder).selectExpr(
        "cc_num", "category", "CASE WHEN cc_num % 3 = 0 THEN NULL ELSE state END AS state"
    )
    return profile.duplicate_count(rows)


@query
def q_fraud_rate(spark, folder):
    return rounded(profile.class_balance(transactions(spark, folder)))


@query
def q_quality_report(spark, folder):
    train, test = _parts(spark, folder)
    return rounded(profile.quality_report(
        {"train": train, "test": test.drop(LABEL), "with_gaps": _with_gaps(spark, folder)}
    ))


@query
def q_distinct(spark, folder):
    return profile.distinct_counts(transactions(spark, folder))


@query
def q_value_counts(spark, folder):
    return profile.value_counts(_with_gaps(spark, folder), "category")


@query
def q_value_counts_sorted(spark, folder):
    return profile.value_counts(_enriched(spark, folder), "age", sort_by_value=True)


@query
def q_describe(spark, folder):
    return rounded(profile.describe(transactions(spark, folder), "amt"))


@query
def q_describe_by_class(spark, folder):
    return rounded(profile.describe(_enriched(spark, folder), "distance_km", [LABEL]))


@query
def q_info(spark, folder):
    return profile.info(_with_gaps(spark, folder))


@query
def q_share(spark, folder):
    return rounded(profile.share(_enriched(spark, folder), "period_of_day"))


@query
def q_preview(spark, folder):
    return profile.preview(transactions(spark, folder), 10)


# --- projections and filters -----------------------------------------------------------------

@query
def p_drop(spark, folder):
    rows = project.drop_columns(feat.enrich(transactions(spark, folder)), NOT_MODELLED + ["absent"])
    return rounded(rows.drop("split"))


@query
def p_class_filter(spark, folder):
    return project.of_class(transactions(spark, folder), 1)


@query
def p_select_types(spark, folder):
    view = transactions(spark, folder)
    return view.select(checks.numeric_columns(view))


@query
def p_select_text(spark, folder):
    view = transactions(spark, folder)
    return view.select("id", *checks.text_columns(view))


@query
def p_align(spark, folder):
    train, test = _parts(spark, folder)
    left, right = project.align(
        train.select("id", "amt", "city_pop", LABEL), test.select("id", "amt", "lat")
    )
    left = left.withColumn("part", F.lit("train"))
    right = right.withColumns({LABEL: F.lit(None).cast("int"), "part": F.lit("test")})
    return left.unionByName(right)


@query
def p_xy(spark, folder):
    rows = _enriched(spark, folder)
    columns = ["amt", "age", "trans_hour", "city_pop"]
    with_label = project.split_xy(rows.where("split = 'train'"), columns)
    without = project.split_xy(rows.where("split = 'test'").drop(LABEL), columns)
    return with_label.unionByName(without).select(
        "id", *[F.col("features")[i].alias(f"x{i}") for i in range(len(columns))], "label"
    )


@query
def p_threshold(spark, folder):
    return _model_scores(spark, folder).select("id", "model", "prediction")


@query
def p_request_fill(spark, folder):
    requests = _enriched(spark, folder).select("id", "amt", "trans_hour", "trans_month", "age", "city_pop")
    return project.request_features(requests, FEATURES, ["id"])


@query
def p_request_defaults(spark, folder):
    requests = _enriched(spark, folder).selectExpr(
        "id", "amt", "trans_hour", "trans_month", "age", "city_pop",
        "CASE WHEN id % 2 = 0 THEN is_weekend END AS is_weekend",
        "CASE WHEN id % 3 = 0 THEN gender_encoded END AS gender_encoded",
    )
    return project.request_defaults(requests)


# --- joins -----------------------------------------------------------------------------------

@query
def j_assign_by_key(spark, folder):
    """Bring the training rows' birth dates onto all rows; test rows have no partner."""
    view = transactions(spark, folder)
    return joins.assign_by_key(
        view.select("id", "amt"), split_of(view, "train"), "id", "dob", "train_dob"
    )


@query
def j_coef_table(spark, folder):
    rows, columns = _ascent_rows(spark, folder)
    long = gradient.gradient_ascent(rows, columns, LABEL, gradient.PENALTIES)
    return rounded(joins.combine_coefficients(long, gradient.PENALTIES), 9)


@query
def j_knn(spark, folder):
    minority = _train(spark, folder).where(F.col(LABEL) == 1)
    return rounded(knn.nearest_neighbours(minority, "id", NEIGHBOUR_COLUMNS, 5), 3)


@query
def j_dictionary(spark, folder):
    train, test = _parts(spark, folder)
    codes = encode.dictionary("merchant", train, test)
    return encode.apply_dictionary(
        test.select("id", "merchant"), "merchant", codes, name="merchant_code"
    )


# --- exploratory reports ---------------------------------------------------------------------

@query
def a_rate_hour(spark, folder):
    return rounded(eda.rate_by(feat.add_temporal(transactions(spark, folder)), "trans_hour"))


@query
def a_rate_month(spark, folder):
    return rounded(eda.rate_by(feat.add_temporal(transactions(spark, folder)), "trans_month"))


@query
def a_rate_age(spark, folder):
    return rounded(eda.crosstab_rate(feat.add_demographic(transactions(spark, folder)), "age_group"))


@query
def a_rate_gender(spark, folder):
    return rounded(eda.crosstab_rate(transactions(spark, folder), "gender"))


@query
def a_fraud_counts(spark, folder):
    return eda.positive_counts(_enriched(spark, folder))


@query
def a_hist_density(spark, folder):
    return rounded(eda.histogram(_enriched(spark, folder), "amt", 50, LABEL, density=True))


@query
def a_hist_distance(spark, folder):
    return rounded(eda.histogram(_enriched(spark, folder), "distance_km", 50, LABEL, density=True))


@query
def a_hist_count(spark, folder):
    return rounded(eda.histogram(transactions(spark, folder), "amt", 50))


@query
def a_kde(spark, folder):
    return rounded(eda.density_curve(transactions(spark, folder), "amt"), 9)


@query
def a_corr(spark, folder):
    return rounded(eda.correlations(_enriched(spark, folder), CORRELATED))


@query
def a_corr_lower(spark, folder):
    return rounded(eda.correlations(_enriched(spark, folder), CORRELATED, lower_only=True))


@query
def a_vif(spark, folder):
    return rounded(eda.variance_inflation(_train(spark, folder), COLLINEAR), 5)


@query
def a_class_ratio(spark, folder):
    train, _ = _parts(spark, folder)
    return rounded(profile.class_balance(train).select("n_negative", "n_positive", "scale_pos_weight"))


# --- top-k and set operations ----------------------------------------------------------------

@query
def t_top_features(spark, folder):
    """Numeric columns by the size of their correlation with the label."""
    strength = eda.correlations(_enriched(spark, folder), CORRELATED).where(
        (F.col("column_a") == LABEL) & (F.col("column_b") != LABEL)
    ).select(F.col("column_b").alias("feature"), F.round(F.abs("r"), 6).alias("importance"))
    return rounded(ranking.top_features(strength, 20))


@query
def t_argmax(spark, folder):
    results = evaluate.full_metrics(_model_scores(spark, folder).where("split = 'test'"))
    return rounded(ranking.arg_max(evaluate.comparison(results).select("model", "score"), "score", "model"))


@query
def t_first_n(spark, folder):
    return ranking.first_rows(transactions(spark, folder), 200)


@query
def u_union_all(spark, folder):
    train, test = _parts(spark, folder)
    return joins.union_all(train, test, project.of_class(train, 1))


# --- scalar features -------------------------------------------------------------------------

@query
def f_temporal(spark, folder):
    return feat.add_temporal(transactions(spark, folder)).select(
        "id", "trans_month", "trans_day", "trans_hour", "trans_weekday", "quarter"
    )


@query
def f_flags(spark, folder):
    return feat.add_temporal(transactions(spark, folder)).select(
        "id", "is_weekend", "is_night", "is_business_hours", "is_holiday_season", "is_tax_season"
    )


@query
def f_cyclic(spark, folder):
    return rounded(feat.add_temporal(transactions(spark, folder)).select(
        "id", "hour_sin", "hour_cos", "month_sin", "month_cos"
    ))


@query
def f_period_of_day(spark, folder):
    return _enriched(spark, folder).select("id", "period_of_day")


@query
def f_age(spark, folder):
    return feat.add_demographic(transactions(spark, folder)).select("id", "age")


@query
def f_age_group(spark, folder):
    return feat.add_demographic(transactions(spark, folder)).select("id", "age_group")


@query
def f_age_group_nb(spark, folder):
    return _enriched(spark, folder).select("id", "age_band")


@query
def f_gender(spark, folder):
    return _enriched(spark, folder).select("id", "gender_encoded", "gender_flag")


@query
def f_city_pop(spark, folder):
    return _enriched(spark, folder).select("id", "city_pop_category", "city_pop_group")


@query
def f_distance(spark, folder):
    return rounded(feat.add_geographic(transactions(spark, folder)).select(
        "id", "distance_km", "is_distant_transaction"
    ))


def _with_state_codes(spark, folder):
    """The synthetic state names mapped onto state codes, so that every region occurs."""
    codes = sorted({s for states in feat.CENSUS_REGIONS.values() for s in states} | {"CA", "WA"})
    listed = ", ".join(f"'{c}'" for c in codes)
    return transactions(spark, folder).select(
        "id", F.expr(f"element_at(array({listed}), CAST(cc_num % {len(codes)} + 1 AS INT))").alias("state")
    )


@query
def f_region(spark, folder):
    return _with_state_codes(spark, folder).select(
        "id", "state", F.expr(feat.region_of("state")).alias("state_region"),
        F.expr(feat.region_of("state", feat.CENSUS_REGIONS)).alias("census_region"),
    )


@query
def f_interactions(spark, folder):
    rows = feat.add_interactions(_enriched(spark, folder))
    return rows.select("id", *[c for c in rows.columns if "_x_" in c])


@query
def f_sigmoid(spark, folder):
    rows = _enriched(spark, folder)
    return rounded(rows.select("id", feat.sigmoid(feat.linear_score(LINEAR, LINEAR_INTERCEPT)).alias("p")))


@query
def f_risk(spark, folder):
    return _model_scores(spark, folder).select(
        "id", "model", feat.risk_level(F.col("score")).alias("risk_level")
    )


def _test_results(spark, folder):
    return evaluate.full_metrics(_model_scores(spark, folder).where("split = 'test'"))


@query
def f_composite(spark, folder):
    return rounded(_test_results(spark, folder).select(
        "model", feat.composite_score(F.col("recall"), F.col("f1"), F.col("auc")).alias("score")
    ))


@query
def f_model_name(spark, folder):
    return _model_scores(spark, folder).groupBy("model").agg(F.count(F.lit(1)).alias("n")).select(
        "n", feat.display_name(F.col("model")).alias("name"),
        feat.model_key(feat.display_name(F.col("model"))).alias("key"),
    )


@query
def f_round(spark, folder):
    return feat.round_half_even(
        _test_results(spark, folder).select("model", "accuracy", "precision", "recall", "f1", "auc"), 4
    )


# --- transformers ----------------------------------------------------------------------------

@query
def m_label_encode(spark, folder):
    train, test = pipeline.coded(*_parts(spark, folder))
    return train.unionByName(test).select("id", *CATEGORICAL)


@query
def m_one_hot(spark, folder):
    """Dummies fitted on the training rows, applied to both parts."""
    train, test = _parts(spark, folder)
    levels = {"category": encode.category_levels(train, "category")}
    both = train.unionByName(test).select("id", "category")
    return encode.one_hot(both, ["category"], levels)


@query
def m_one_hot_vector(spark, folder):
    """The place of the one in each test row's merchant vector, -1 if it is all zeros."""
    train, test = _parts(spark, folder)
    coded = encode.one_hot_vector(test.select("id", "merchant"), "merchant", encode.dictionary("merchant", train))
    cells = vector_to_array("merchant_vector")
    return coded.select("id", F.size(cells).alias("size"), (F.array_position(cells, 1.0) - 1).alias("place"))


@query
def m_scale(spark, folder):
    rows = _enriched(spark, folder)
    return rounded(encode.standardise(
        rows.select("id", "split", *COMPACT_SCALED), COMPACT_SCALED,
        rows.where("split = 'train'"),
    ))


COMPACT_SCALED = ["gender_flag" if c == "gender" else c for c in COMPACT_FEATURES]


@query
def m_smote(spark, folder):
    train, _ = pipeline.coded(*_parts(spark, folder))
    return rounded(resample.smote_samples(train, FEATURES).drop("step"))


@query
def m_bootstrap(spark, folder):
    return resample.bootstrap(split_of(transactions(spark, folder), "train"))


@query
def m_class_weight(spark, folder):
    train, _ = _parts(spark, folder)
    return rounded(resample.class_weights(train))


@query
def m_folds(spark, folder):
    train, _ = _parts(spark, folder)
    return resample.stratified_folds(train, 5).select("id", LABEL, "fold")


@query
def m_fold_split(spark, folder):
    """Size and positives of the training and validation part of every fold."""
    train, _ = _parts(spark, folder)
    return resample.fold_sizes(resample.stratified_folds(train, 3))


@query
def m_assemble(spark, folder):
    train, _ = pipeline.coded(*_parts(spark, folder))
    rows = encode.assemble(train, FEATURES).select("id", vector_to_array("features").alias("v"))
    return rounded(rows.select("id", *[F.col("v")[i].alias(f"v{i:02d}") for i in range(len(FEATURES))]))


@query
def m_model_table(spark, folder):
    train, test = pipeline.engineered(*_parts(spark, folder))
    return rounded(train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    ))


# --- estimators ------------------------------------------------------------------------------

def _fit_and_score(spark, folder, kind, params=None, balance=None):
    train, test = _parts(spark, folder)
    model = training.train(training.KINDS[kind], train, params, balance)
    return training.predictions(model, test)


@query
def e_lr(spark, folder):
    return _fit_and_score(spark, folder, "logistic_regression")


@query
def e_dt(spark, folder):
    return _fit_and_score(spark, folder, "decision_tree")


@query
def e_rf(spark, folder):
    return _fit_and_score(spark, folder, "random_forest")


@query
def e_gbt(spark, folder):
    return _fit_and_score(spark, folder, "gradient_boosting")


@query
def e_tree_stump(spark, folder):
    """A balanced decision tree of depth one over columns of few values: the best Gini cut and its leaves' rates.

    (Spark drops a cut whose leaves predict the same class, so balanced classes are needed to see one.)
    """
    rows = _enriched(spark, folder).withColumn("amt_band", F.floor(F.col("amt") / 25))
    kind = training.KINDS["decision_tree"]
    model = training.fit_table(kind, rows.where("split = 'train'"), {"max_depth": 1, "class_weight": "balanced"}, columns=ROUND_COLUMNS)
    return rounded(training.predictions(model, rows.where("split = 'test'")), 9)


@query
def e_exact_tree(spark, folder):
    """A tree with exact cuts grown to its last leaf, on the test rows."""
    train, test = _parts(spark, folder)
    features = pipeline.fit_features(train)
    model = exacttree.fit_exact_tree(pipeline.model_table(features, train), pipeline.MODEL_COLUMNS)
    return model.predictions(pipeline.model_table(features, test))


@query
def e_exact_depth3(spark, folder):
    """The exact tree of depth three over columns of many values with balanced classes, on the test rows."""
    rows = _enriched(spark, folder)
    model = exacttree.fit_exact_tree(rows.where("split = 'train'"), EXACT_COLUMNS, max_depth=3, class_weight="balanced", small=1024)
    return rounded(model.predictions(rows.where("split = 'test'")), 9)


@query
def e_exact_leaves(spark, folder):
    """Without a limit every training row ends among its equals: its score is their positive share."""
    rows = _enriched(spark, folder).withColumn("amt_band", F.floor(F.col("amt") / 25)).where("split = 'train'")
    return rounded(exacttree.fit_exact_tree(rows, ROUND_COLUMNS).predictions(rows), 9)


@query
def e_lr_dummies(spark, folder):
    """A logistic model without penalty over the dummies of one column gives every level its own rate."""
    rows = _enriched(spark, folder)
    levels = {"period_of_day": encode.category_levels(rows.where("split = 'train'"), "period_of_day")}
    wide = encode.one_hot(rows.select("id", "split", LABEL, "period_of_day"), ["period_of_day"], levels)
    columns = [c for c in wide.columns if c not in ("id", "split", LABEL)]
    params = {"C": 1e12, "max_iter": 500, "tol": 1e-12}
    model = training.fit_table(training.KINDS["logistic_regression"], wide.where("split = 'train'"), params, columns=columns)
    return rounded(training.predictions(model, wide.where("split = 'test'")), 5)


@query
def e_boosting(spark, folder):
    """Second-order boosted trees with their default parameters and balanced classes, on the test rows."""
    train, test = _parts(spark, folder)
    features = pipeline.fit_features(train)
    model = boosted.train(pipeline.model_table(features, train), boosted.Params(scale_pos_weight=None))
    return model.predictions(pipeline.model_table(features, test))


@query
def e_boosting_round(spark, folder):
    """One round of depth one with leaf penalties: the best cut and its two leaves."""
    rows = _enriched(spark, folder).withColumn("amt_band", F.floor(F.col("amt") / 25))
    params = boosting.Params(n_estimators=1, max_depth=1, scale_pos_weight=None, **ROUND_PARAMS)
    model = boosting.fit_boosted(rows.where("split = 'train'"), ROUND_COLUMNS, params)
    return rounded(model.predictions(rows.where("split = 'test'")), 9)


@query
def e_boosting_search(spark, folder):
    """Twenty draws from the boosted grid, three folds; the winner validated in five folds, refitted and tested."""
    _, report, results = boosted.full_run(*_parts(spark, folder))
    won = results.select("params", "cv_f1_mean", "cv_auc_mean", F.col("f1").alias("test_f1"), F.col("auc").alias("test_auc"))
    return report.join(won, "params", "left")


@query
def e_boosting_grid(spark, folder):
    """The 54 points of the boosted grid, five folds, accuracy: 18 fits a fold."""
    return boosted.grid_search(_table(spark, folder))[1]


def _ascent_rows(spark, folder, apply_to: str = "train"):
    """Standardised compact features with category dummies, upsampled training rows."""
    rows = _enriched(spark, folder).select("id", "split", *ASCENT_BASE, "category", LABEL)
    levels = {"category": encode.category_levels(rows.where("split = 'train'"), "category")}
    wide = encode.one_hot(rows, ["category"], levels)
    columns = [c for c in wide.columns if c not in ("id", "split", LABEL)]
    up = resample.upsample(wide.where("split = 'train'"))
    if apply_to == "train":
        return encode.standardise(up, columns), columns
    return encode.standardise(wide.where("split = 'test'"), columns, up), columns


@query
def e_grad_ascent(spark, folder):
    rows, columns = _ascent_rows(spark, folder)
    return rounded(gradient.gradient_ascent(rows, columns, LABEL, [4.0]), 9)


@query
def e_loglik(spark, folder):
    rows = _train(spark, folder)
    return rounded(gradient.log_likelihood(rows, LINEAR, LABEL, penalty=10.0, unpenalised=["amt"]), 4)


@query
def e_l2_sweep(spark, folder):
    """Report on the test rows for every penalty."""
    rows, columns = _ascent_rows(spark, folder)
    fitted = gradient.gradient_ascent(rows, columns, LABEL, gradient.PENALTIES)
    test, _ = _ascent_rows(spark, folder, "test")
    scored = gradient.score_with_penalties(test, fitted, columns, ["id", LABEL]).withColumns({
        "label": F.col(LABEL), "prediction": feat.over_threshold(F.col("score")),
    })
    return rounded(evaluate.classification_report(scored, by=["penalty"]))


def _table(spark, folder):
    train, _ = _parts(spark, folder)
    return pipeline.model_table(pipeline.fit_features(train), train)


@query
def e_random_search(spark, folder):
    """All eight points of the logistic grid, three folds, F1 of class 1."""
    kind = training.KINDS["logistic_regression"]
    return training.random_search(kind, _table(spark, folder), n_iter=10)[1]


@query
def e_random_search_forest(spark, folder):
    """Twenty draws from the forest grid; the winner's parameters are capped for training."""
    ranked, report = training.random_search(training.KINDS["random_forest"], _table(spark, folder))
    capped = training.cap_forest(ranked[0])
    return report.withColumns({
        "capped_trees": F.lit(capped["n_estimators"]), "capped_depth": F.lit(capped["max_depth"]),
    })


@query
def e_grid_search(spark, folder):
    kind = training.KINDS["logistic_regression"]
    return training.grid_search(kind, _table(spark, folder), training.LOGISTIC_GRID)[1]


@query
def e_cv(spark, folder):
    """F1 and AUC per fold, with SMOTE inside the training part only, and their means."""
    folds = training.cross_validate(
        training.KINDS["logistic_regression"], _table(spark, folder), {"C": 1.0}, 5, "smote"
    )
    means = training.mean_scores(folds)
    return folds.select("model", "fold", "f1", "auc").unionByName(means.select(
        "model", F.lit(None).cast("int").alias("fold"), F.col("cv_f1_mean").alias("f1"),
        F.col("cv_auc_mean").alias("auc"),
    ))


@query
def e_refit_predict(spark, folder):
    """Search the whole logistic grid, refit on all balanced training rows, predict the test rows."""
    train, test = _parts(spark, folder)
    kind = training.KINDS["logistic_regression"]
    features = pipeline.fit_features(train)
    best = training.random_search(kind, pipeline.model_table(features, train))[0][0]
    model = training.train(kind, train, {**kind.params, **best}, "smote", features)
    return training.predictions(model, test)


@query
def e_full_run(spark, folder):
    """Search, five-fold validation, refit and test metrics of the logistic model."""
    return training.full_run(training.KINDS["logistic_regression"], *_parts(spark, folder))[1]


@query
def e_full_run_forest(spark, folder):
    """Twenty draws, five-fold validation, refit under the caps and test metrics of the forest."""
    return training.full_run(training.KINDS["random_forest"], *_parts(spark, folder))[1]


def _all_models(spark, folder):
    kinds = [training.KINDS[k] for k in ("logistic_regression", "random_forest", "gradient_boosting")]
    models, status, scored = training.train_all(*_parts(spark, folder), kinds)
    return models, status, evaluate.comparison(evaluate.full_metrics(scored))


@query
def e_train_all(spark, folder):
    _, status, results = _all_models(spark, folder)
    return status.join(results, "model", "left")


# --- evaluation ------------------------------------------------------------------------------

@query
def v_confusion(spark, folder):
    return evaluate.confusion(_model_scores(spark, folder), by=["model"])


@query
def v_metrics(spark, folder):
    return rounded(evaluate.metrics(_model_scores(spark, folder), by=["model"]))


@query
def v_auc(spark, folder):
    return rounded(evaluate.auc(_model_scores(spark, folder), by=["model"]))


@query
def v_roc(spark, folder):
    return rounded(evaluate.roc_curve(_one_score(spark, folder)))


@query
def v_report(spark, folder):
    return rounded(evaluate.classification_report(_model_scores(spark, folder), by=["model"]))


@query
def v_fold_metrics(spark, folder):
    scores = _one_score(spark, folder).withColumnRenamed("label", LABEL)
    folded = resample.stratified_folds(scores, 5)
    return rounded(evaluate.full_metrics(folded, label=LABEL, by=["fold"]).select("fold", "f1", "auc"))


@query
def v_compare(spark, folder):
    return rounded(evaluate.comparison(_test_results(spark, folder)))


@query
def v_best(spark, folder):
    return rounded(evaluate.best_model(_test_results(spark, folder)))


@query
def v_roc_all(spark, folder):
    return rounded(evaluate.roc_curve(_model_scores(spark, folder), by=["model"], drop_collinear=False))


@query
def v_overfit(spark, folder):
    return rounded(evaluate.generalisation_gap(_model_scores(spark, folder), by=["model"]))


@query
def v_type2(spark, folder):
    return rounded(evaluate.type2_share(_model_scores(spark, folder), by=["model"]))


@query
def v_threshold(spark, folder):
    return rounded(evaluate.threshold_sweep(_model_scores(spark, folder), THRESHOLDS, by=["model"]))


# --- explainability --------------------------------------------------------------------------

@query
def x_importance(spark, folder):
    train, _ = _parts(spark, folder)
    return explain.importances(training.train(training.KINDS["random_forest"], train), FEATURES)


@query
def x_ranking(spark, folder):
    """Features of the model with the best weighted score on the test rows, by importance; fails if a model does."""
    models, status, results = _all_models(spark, folder)
    training.all_trained(status)
    return explain.rank_features(models[evaluate.arg_max(results, "score", "model").first().model], FEATURES)


@query
def x_linear_shap(spark, folder):
    return rounded(explain.linear_shap(_enriched(spark, folder), LINEAR, LINEAR_INTERCEPT))


@query
def x_tree_shap(spark, folder):
    train, test = _parts(spark, folder)
    model = training.train(training.KINDS["gradient_boosting"], train)
    return explain.tree_shap(model, test, FEATURES)


@query
def x_shap_summary(spark, folder):
    return rounded(explain.shap_summary(
        explain.linear_shap(_enriched(spark, folder), LINEAR, LINEAR_INTERCEPT)
    ))


# --- scoring and streams ---------------------------------------------------------------------

@query
def d_preprocess(spark, folder):
    """Requests with five fields, filled, ordered and scaled with the training statistics."""
    rows = _enriched(spark, folder)
    numeric = [c for c in FEATURES if c not in CATEGORICAL]
    fitted = rows.where("split = 'train'").agg(*[
        f(F.col(c).cast("double")).alias(f"{n}_{c}")
        for c in numeric for n, f in (("mean", F.avg), ("std", F.stddev_pop))
    ]).first()
    requests = rows.where("split = 'test'").select(
        "id", "amt", "trans_hour", "trans_month", "age", "city_pop"
    )
    return rounded(scoring.preprocess(
        requests, numeric, {c: fitted[f"mean_{c}"] for c in numeric},
        {c: fitted[f"std_{c}"] for c in numeric}, ["id"],
    ))


@query
def d_score(spark, folder):
    return rounded(scoring.score_linear(
        feat.enrich(transactions(spark, folder)), LINEAR, LINEAR_INTERCEPT
    ))


@query
def d_score_model(spark, folder):
    train, test = _parts(spark, folder)
    return scoring.score(training.train(training.KINDS["logistic_regression"], train), test)


@query
def d_stream_score(spark, folder):
    """The events table as a file stream, scored in micro-batches."""
    def scorer(events):
        rows = events.withColumn("hour", F.hour("ts"))
        return scoring.score_linear(rows, {"value": 0.02, "hour": 0.05}, -2.0, ["event_id"])

    source = stream.file_stream(spark, folder, SCHEMAS["events"], "events.parquet")
    return rounded(stream.drain(stream.score_stream(source, scorer)))


@query
def d_risk_summary(spark, folder):
    return rounded(scoring.risk_summary(scoring.score_linear(
        feat.enrich(transactions(spark, folder)), LINEAR, LINEAR_INTERCEPT
    )))


def _event_rates(spark, folder):
    source = stream.file_stream(spark, folder, SCHEMAS["events"], "events.parquet").withColumn(
        "flag", (F.col("value") > 100).cast("int")
    )
    return stream.hourly_rate(source, "ts", "flag")


@query
def d_stream_rate(spark, folder):
    """Share of high-value events per hour, the open hours at the end of the feed included."""
    return rounded(stream.upsert_hours(_event_rates(spark, folder)))


@query
def d_stream_rate_final(spark, folder):
    """The same, appended once the watermark has passed an hour, so that a row is final."""
    return rounded(stream.drain(_event_rates(spark, folder)))
