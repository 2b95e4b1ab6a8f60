"""The catalog's queries as DuckDB SQL over the same tables.

Floating results are rounded on both sides; ``+ 0.0`` turns -0.0 into 0.0. A query without an
entry here (trained trees, searches) has no SQL form and is covered by property tests.
"""
from __future__ import annotations

from itertools import combinations

from cardwatch.functions import features as feat
from cardwatch.operators import gradient
from cardwatch.plans import catalog as cat
from cardwatch.schema import CATEGORICAL, FEATURES, NOT_MODELLED, REQUEST_DEFAULTS

TX = """transactions AS (
SELECT o.o_orderkey AS id,
  o.o_orderdate + to_seconds((o.o_orderkey*7919) % 86400) AS trans_date_trans_time,
  o.o_custkey AS cc_num, concat('merchant_', cast(o.o_orderkey % 700 AS varchar)) AS merchant,
  o.o_orderpriority AS category, o.o_totalprice/1000.0e0 AS amt,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, n.n_name AS state,
  25.0e0 + ((c.c_custkey*31) % 2400)/100.0e0 AS lat,
  -125.0e0 + ((c.c_custkey*37) % 5800)/100.0e0 AS long,
  500 + (c.c_custkey*104729) % 1500000 AS city_pop,
  date '1925-01-01' + cast((c.c_custkey*7907) % 30000 AS int) AS dob,
  25.0e0 + ((c.c_custkey*31) % 2400)/100.0e0 + ((o.o_orderkey*13) % 240 - 120)/100.0e0 AS merch_lat,
  -125.0e0 + ((c.c_custkey*37) % 5800)/100.0e0 + ((o.o_orderkey*29) % 240 - 120)/100.0e0 AS merch_long,
  CASE WHEN o.o_totalprice > 400000 AND (o.o_orderkey*17 + c.c_custkey*3) % 10 < 3 THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN o.o_orderkey % 10 < 7 THEN 'train' ELSE 'test' END AS split
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def _case(column: str, bins) -> str:
    arms = " ".join(
        f"WHEN {column} > {low}" + ("" if high is None else f" AND {column} <= {high}")
        + f" THEN '{label}'" for low, high, label in bins
    )
    return f"CASE {arms} END"


FEAT = f"""{TX}, calendar AS (
SELECT *, CAST(month(trans_date_trans_time) AS INTEGER) AS trans_month,
  dayname(trans_date_trans_time) AS trans_day,
  CAST(hour(trans_date_trans_time) AS INTEGER) AS trans_hour,
  CAST(isodow(trans_date_trans_time) - 1 AS INTEGER) AS trans_weekday,
  CAST(quarter(trans_date_trans_time) AS INTEGER) AS quarter,
  CAST(floor(date_diff('day', dob, DATE '2021-01-01') / 365.0e0) AS INTEGER) AS age,
  2.0e0 * 6371 * asin(least(1.0e0, sqrt(
    pow(sin(radians(merch_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(merch_lat))
    * pow(sin(radians(merch_long - long) / 2), 2)))) AS distance_km
FROM transactions), feat AS (
SELECT *, CASE WHEN trans_weekday IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN trans_hour IN (22, 23, 0, 1, 2, 3, 4, 5) THEN 1 ELSE 0 END AS is_night,
  CASE WHEN trans_hour BETWEEN 9 AND 16 THEN 1 ELSE 0 END AS is_business_hours,
  CASE WHEN trans_month IN (11, 12) THEN 1 ELSE 0 END AS is_holiday_season,
  CASE WHEN trans_month IN (1, 2, 3, 4) THEN 1 ELSE 0 END AS is_tax_season,
  sin(2 * pi() * trans_hour / 24) AS hour_sin, cos(2 * pi() * trans_hour / 24) AS hour_cos,
  sin(2 * pi() * trans_month / 12) AS month_sin, cos(2 * pi() * trans_month / 12) AS month_cos,
  {_case('age', feat.AGE_BINS)} AS age_group,
  CASE gender WHEN 'M' THEN 1 WHEN 'F' THEN 0 END AS gender_encoded,
  {_case('city_pop', feat.CITY_BINS)} AS city_pop_category,
  CASE WHEN distance_km > 100 THEN 1 ELSE 0 END AS is_distant_transaction,
  CASE WHEN trans_hour >= 6 AND trans_hour < 12 THEN 'morning'
    WHEN trans_hour >= 12 AND trans_hour < 18 THEN 'afternoon'
    WHEN trans_hour >= 18 THEN 'evening' ELSE 'midnight' END AS period_of_day,
  CASE WHEN age >= 0 AND age < 18 THEN 'minor' WHEN age >= 18 AND age < 30 THEN 'young adult'
    WHEN age >= 30 AND age < 50 THEN 'adult' ELSE 'senior' END AS age_band,
  CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_flag,
  {_case('city_pop', [(a, b, l) for (a, b, _), l in zip(feat.CITY_BINS, feat.CITY_GROUP_LABELS)])}
    AS city_pop_group,
  'West' AS state_region
FROM calendar)"""
# The given nation names are not state codes, so the fallback region is the only one they have;
# f_region checks the whole table of states.

GAPS = f"""{TX}, gaps AS (
SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE category END AS category,
  CASE WHEN id % 13 = 0 THEN 'NaN'::DOUBLE WHEN id % 17 = 0 THEN NULL ELSE amt END AS amt,
  gender, CASE WHEN id % 3 = 0 THEN NULL ELSE city_pop END AS city_pop, is_fraud
FROM transactions)"""
GAP_COLUMNS = {"id": "bigint", "category": "string", "amt": "double", "gender": "string",
               "city_pop": "bigint", "is_fraud": "int"}
TX_COLUMNS = {
    "id": "bigint", "trans_date_trans_time": "ts", "cc_num": "bigint", "merchant": "string",
    "category": "string", "amt": "double", "gender": "string", "state": "string",
    "lat": "double", "long": "double", "city_pop": "bigint", "dob": "date",
    "merch_lat": "double", "merch_long": "double", "is_fraud": "int",
}


def u(key: str, seed: int) -> str:
    return (f"(('0x' || substr(md5({key} || '-{seed}'), 1, 8))::BIGINT / 4294967296.0e0)")


def sql(ctes: str, body: str, floats=(), digits: int = 6) -> str:
    """``WITH ctes`` plus a body whose floating columns are rounded."""
    if floats:
        fixed = ", ".join(f'round("{c}", {digits}) + 0.0e0 AS "{c}"' for c in floats)
        body = f"SELECT * REPLACE ({fixed}) FROM ({body})"
    return f"WITH {ctes}\n{body}"


def ratio(top: str, bottom: str) -> str:
    return f"(({top})::DOUBLE / nullif(({bottom})::DOUBLE, 0))"


def linear(weights: dict[str, float], intercept: float = 0.0, prefix: str = "") -> str:
    return f"({intercept!r}::DOUBLE" + "".join(
        f" + {w!r}::DOUBLE * {prefix}{c}" for c, w in weights.items()) + ")"


# --- fixed-formula scores --------------------------------------------------------------------

SCORES = f"""{FEAT}, formulas AS (
SELECT id, split, is_fraud AS label, 'logistic_regression' AS model, (amt - 420.0e0) / 25.0e0 AS s FROM feat
UNION ALL SELECT id, split, is_fraud, 'random_forest', (amt - 400.0e0) / 60.0e0 + is_night * 0.5e0 FROM feat
UNION ALL SELECT id, split, is_fraud, 'gradient_boosting',
  (amt - 430.0e0) / 15.0e0 + (trans_hour - 12) / 24.0e0 FROM feat
), rounded AS (
SELECT id, split, label, model, round(1.0e0 / (1.0e0 + exp(-s)), 6) AS score FROM formulas
), scores AS (
SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM rounded)"""

CONFUSION = """count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp"""

RATES = f"""coalesce({ratio('tp + tn', 'tn + fp + fn + tp')}, 0) AS accuracy,
  coalesce({ratio('tp', 'tp + fp')}, 0) AS precision,
  coalesce({ratio('tp', 'tp + fn')}, 0) AS recall,
  coalesce({ratio('2 * tp', '2 * tp + fp + fn')}, 0) AS f1"""


def metrics_ctes(source: str, by: str) -> str:
    """``confusion``, ``rates`` and ``areas`` per group of ``by``."""
    return f"""confusion AS (SELECT {by}, {CONFUSION} FROM {source} GROUP BY {by}),
rates AS (SELECT *, {RATES} FROM confusion),
steps AS (SELECT {by}, score, sum(label) AS n1, sum(1 - label) AS n0 FROM {source} GROUP BY {by}, score),
ranked AS (SELECT *, sum(n0) OVER (PARTITION BY {by} ORDER BY score) AS cum0 FROM steps),
areas AS (SELECT {by}, {ratio('sum(n1::DOUBLE * (cum0 - n0 / 2.0e0))', 'sum(n1)::DOUBLE * sum(n0)')} AS auc
  FROM ranked GROUP BY {by}),
results AS (SELECT * FROM rates JOIN areas USING ({by}))"""


TEST_RESULTS = f"""{SCORES}, test_scores AS (SELECT * FROM scores WHERE split = 'test'),
{metrics_ctes('test_scores', 'model')}"""

COMPARISON = """SELECT model, CASE model WHEN 'logistic_regression' THEN 'Logistic Regression'
  WHEN 'random_forest' THEN 'Random Forest' ELSE 'Gradient Boosting' END AS name,
  accuracy, f1, auc, precision, recall, fn AS false_negatives, fp AS false_positives,
  tp AS true_positives, tn AS true_negatives, recall * 0.4e0 + f1 * 0.4e0 + auc * 0.2e0 AS score
FROM results"""
COMPARISON_FLOATS = ["accuracy", "f1", "auc", "precision", "recall", "score"]


def report(counts: str, by: str) -> str:
    """Classification report rows from a table of confusion counts."""
    def block(name, p, r, f, n):
        return (f"SELECT {by}, '{name}' AS \"row\", {p} AS precision, {r} AS recall, {f} AS f1, "
                f"CAST({n} AS BIGINT) AS support FROM per_class")

    per_class = f"""SELECT {by}, tn + fp AS n0, fn + tp AS n1, tn + fp + fn + tp AS n,
      coalesce({ratio('tn', 'tn + fn')}, 0) AS p0, coalesce({ratio('tn', 'tn + fp')}, 0) AS r0,
      coalesce({ratio('2 * tn', '2 * tn + fn + fp')}, 0) AS f0,
      coalesce({ratio('tp', 'tp + fp')}, 0) AS p1, coalesce({ratio('tp', 'tp + fn')}, 0) AS r1,
      coalesce({ratio('2 * tp', '2 * tp + fp + fn')}, 0) AS f1,
      coalesce({ratio('tp + tn', 'tn + fp + fn + tp')}, 0) AS a FROM {counts}"""
    weighted = ["coalesce({}, 0)".format(ratio(f"{m}0 * n0 + {m}1 * n1", "n")) for m in "prf"]
    blocks = " UNION ALL ".join([
        block("0", "p0", "r0", "f0", "n0"), block("1", "p1", "r1", "f1", "n1"),
        block("accuracy", "a", "a", "a", "n"),
        block("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
        block("weighted avg", *weighted, "n"),
    ])
    return f"SELECT * FROM (WITH per_class AS ({per_class}) {blocks})"


# --- resampling ------------------------------------------------------------------------------

def folds(source: str, k: int, keep: str) -> str:
    return (f"SELECT {keep}, CAST((row_number() OVER (PARTITION BY is_fraud ORDER BY {u('id', 42)}, id) "
            f"- 1) % {k} AS INTEGER) AS fold FROM {source}")


BOOT = f"""train AS (SELECT * EXCLUDE (split) FROM transactions WHERE split = 'train'),
minority AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rn FROM train WHERE is_fraud = 1),
sizes AS (SELECT count(*) FILTER (WHERE is_fraud = 0) AS n0, count(*) FILTER (WHERE is_fraud = 1) AS n1 FROM train),
draws AS (SELECT d AS draw, CAST(floor({u('d', 42)} * n1) AS BIGINT) AS rn
  FROM sizes, LATERAL (SELECT unnest(range(n0)) AS d))"""

CODED = f"""{FEAT}, """ + ", ".join(
    f"codes_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code "
    f"FROM (SELECT DISTINCT {c} FROM feat WHERE {c} IS NOT NULL))" for c in CATEGORICAL
) + ", coded AS (SELECT f.* REPLACE (" + ", ".join(
    f"codes_{c}.code AS {c}" for c in CATEGORICAL
) + ") FROM feat f " + " ".join(
    f"JOIN codes_{c} ON f.{c} = codes_{c}.v" for c in CATEGORICAL
) + ")"


def distance2(columns) -> str:
    return " + ".join(
        f"(a.{c}::DOUBLE - b.{c}::DOUBLE) * (a.{c}::DOUBLE - b.{c}::DOUBLE)" for c in columns
    )


def neighbours(source: str, columns, k: int = 5) -> str:
    return f"""SELECT * FROM (
  SELECT a.id AS id, b.id AS neighbour_id, {distance2(columns)} AS distance2,
    CAST(row_number() OVER (PARTITION BY a.id ORDER BY {distance2(columns)}, b.id) AS INTEGER) AS rank
  FROM {source} a JOIN {source} b ON a.id <> b.id) WHERE rank <= {k}"""


_WHOLE = [c for c in FEATURES if c not in ("amt", "hour_sin", "hour_cos", "month_sin", "month_cos")]
_INT = [c for c in _WHOLE if c != "city_pop"]
_REAL = [c for c in FEATURES if c not in _WHOLE]


def _smote_columns() -> str:
    out = []
    for c in FEATURES:
        moved = f"a.{c}::DOUBLE + step * (b.{c}::DOUBLE - a.{c}::DOUBLE)"
        kind = "BIGINT" if c == "city_pop" else "INTEGER"
        out.append(f"CAST(trunc({moved}) AS {kind}) AS {c}" if c in _WHOLE else f"{moved} AS {c}")
    return ", ".join(out)


SMOTE = f"""{CODED}, minority AS (
  SELECT *, row_number() OVER (ORDER BY id) - 1 AS rn FROM coded WHERE split = 'train' AND is_fraud = 1),
sizes AS (SELECT count(*) FILTER (WHERE is_fraud = 0) AS n0, count(*) FILTER (WHERE is_fraud = 1) AS n1
  FROM coded WHERE split = 'train'),
near AS ({neighbours('minority', FEATURES)}),
picks AS (SELECT d, CAST(floor({u('d', 42)} * n1 * 5) AS BIGINT) AS pick, {u('d', 43)} AS step
  FROM sizes, LATERAL (SELECT unnest(range(n0 - n1)) AS d))"""


# --- gradient ascent -------------------------------------------------------------------------

ASCENT_COLUMNS = [*cat.ASCENT_BASE, "d2", "d3", "d4", "d5"]
_DUMMIES = {"d2": "2-HIGH", "d3": "3-MEDIUM", "d4": "4-NOT SPECIFIED", "d5": "5-LOW"}
_NAMES = {c: (f"category_{_DUMMIES[c]}" if c in _DUMMIES else c) for c in ASCENT_COLUMNS}


def ascent(penalties) -> str:
    """CTEs up to ``wN``: one row of coefficients per penalty after the last iteration."""
    cols = ASCENT_COLUMNS
    wide = ", ".join([*cat.ASCENT_BASE, *[
        f"CASE WHEN category = '{v}' THEN 1 ELSE 0 END AS {d}" for d, v in _DUMMIES.items()]])
    boot = BOOT.replace("SELECT * EXCLUDE (split) FROM transactions",
                        f"SELECT id, is_fraud, {wide} FROM feat")
    fitted = ", ".join(f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in cols)
    scaled = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in cols)
    parts = [FEAT, boot, f"""up AS (SELECT is_fraud, {', '.join(cols)} FROM train WHERE is_fraud = 0
  UNION ALL SELECT is_fraud, {', '.join(cols)} FROM draws JOIN minority USING (rn)),
fitted AS (SELECT {fitted} FROM up),
x AS MATERIALIZED (SELECT is_fraud AS y, {scaled} FROM up, fitted),
w0 AS (SELECT unnest([{', '.join(repr(float(p)) for p in penalties)}])::DOUBLE AS penalty, """
             + ", ".join(f"0.0::DOUBLE AS {c}" for c in cols) + ")"]
    score = " + ".join(f"x.{c} * w.{c}" for c in cols)
    for i in range(gradient.ITERATIONS):
        updated = ", ".join(
            f"max(w_{c}) + {gradient.STEP_SIZE!r} * (sum(e * {c})"
            + ("" if c == cols[0] else f" - 2 * penalty * max(w_{c})") + f") AS {c}" for c in cols
        )
        olds = ", ".join(f"w.{c} AS w_{c}" for c in cols)
        plain = ", ".join(f"x.{c}" for c in cols)
        parts.append(f"""w{i + 1} AS MATERIALIZED (SELECT penalty, {updated} FROM (
  SELECT w.penalty, {plain}, {olds}, y - 1.0e0 / (1.0e0 + exp(-({score}))) AS e
  FROM x, w{i} w) GROUP BY penalty)""")
    return ",\n".join(parts)


_LAST = f"w{gradient.ITERATIONS}"


def _ascent_long(penalties) -> str:
    return " UNION ALL ".join(
        f"SELECT penalty, '{_NAMES[c]}' AS feature, {c} AS coefficient FROM {_LAST}"
        for c in ASCENT_COLUMNS
    )


# --- correlation and collinearity ------------------------------------------------------------

def _corr_pairs(pairs) -> str:
    """Long form of one wide row of correlations."""
    wide = ", ".join(f"corr({a}::DOUBLE, {b}::DOUBLE) AS r{i}" for i, (a, b) in enumerate(pairs))
    rows = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, r{i} AS r FROM wide"
        for i, (a, b) in enumerate(pairs)
    )
    return f"{FEAT}, wide AS (SELECT {wide} FROM feat)", rows


def vif_sql() -> str:
    """Gram matrix of unit-length columns, inverted by sweeping one column after the other."""
    cols = cat.COLLINEAR
    sums = ", ".join(
        f"sum({a}::DOUBLE * {b}::DOUBLE) AS g_{i}_{j}"
        for i, a in enumerate(cols) for j, b in enumerate(cols)
    )
    cells = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, g_{i}_{j} / sqrt(g_{i}_{i} * g_{j}_{j}) AS v FROM gram"
        for i in range(len(cols)) for j in range(len(cols))
    )
    steps = [f"{FEAT}, gram AS (SELECT {sums} FROM feat WHERE split = 'train')", f"s0 AS ({cells})"]
    for k in range(len(cols)):
        steps.append(f"""s{k + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE
  WHEN a.i = {k} AND a.j = {k} THEN -1.0e0 / p.v
  WHEN a.i = {k} OR a.j = {k} THEN a.v / p.v
  ELSE a.v - r.v * c.v / p.v END AS v
FROM s{k} a JOIN s{k} r ON r.i = a.i AND r.j = {k} JOIN s{k} c ON c.i = {k} AND c.j = a.j,
  (SELECT v FROM s{k} WHERE i = {k} AND j = {k}) p)""")
    names = "[" + ", ".join(f"'{c}'" for c in cols) + "]"
    body = (f"SELECT {names}[i + 1] AS feature, -v AS vif, -v <= 10 AS keep "
            f"FROM s{len(cols)} WHERE i = j")
    return sql(",\n".join(steps), body, ["vif"], 5)


def histogram_sql(column: str, by: str | None, density: bool, source: str = "feat") -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    using = f"USING ({by}, bin)" if by else "USING (bin)"
    group = f"GROUP BY {by}" if by else ""
    ctes = f"""{FEAT}, ranges AS (SELECT {keys}min({column}) AS lo, max({column}) AS hi, count(*) AS total
  FROM {source} {group}),
guess AS (SELECT {keys}{column} AS x, min({column}) OVER ({part}) AS lo, max({column}) OVER ({part}) AS hi,
  FROM {source}),
binned AS (SELECT *, (hi - lo) / 50 AS w, least(floor((x - lo) * (50.0e0 / (hi - lo))), 49) AS b FROM guess),
placed AS (SELECT {keys}CAST(CASE WHEN x < lo + b * w THEN b - 1
  WHEN b < 49 AND x >= lo + (b + 1) * w THEN b + 1 ELSE b END AS INTEGER) AS bin FROM binned),
counts AS (SELECT {keys}bin, count(*) AS n FROM placed GROUP BY {keys}bin),
slots AS (SELECT *, (hi - lo) / 50 AS w, CAST(unnest(range(50)) AS INTEGER) AS bin FROM ranges)"""
    extra = ", coalesce(n, 0) / (total * w) AS density" if density else ""
    body = f"""SELECT {keys}bin, lo + bin * w AS bin_start,
  CASE WHEN bin = 49 THEN hi ELSE lo + (bin + 1) * w END AS bin_end, coalesce(n, 0) AS n{extra}
FROM slots LEFT JOIN counts {using}"""
    return sql(ctes, body, ["bin_start", "bin_end", *(["density"] if density else [])])


def describe_sql(column: str, by: str | None) -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    body = f"""SELECT {keys}count({column}) AS count, avg({column}) AS mean, stddev_samp({column}) AS std,
  min({column}) AS min, quantile_cont({column}, 0.25) AS p25, quantile_cont({column}, 0.5) AS p50,
  quantile_cont({column}, 0.75) AS p75, max({column}) AS max FROM feat {group}"""
    return sql(FEAT, body, ["mean", "std", "min", "p25", "p50", "p75", "max"])


def rate_sql(column: str) -> str:
    return sql(FEAT, f"""SELECT {column}, CASE WHEN sum(is_fraud) > 0 AND sum(1 - is_fraud) > 0
  THEN sum(is_fraud)::DOUBLE / count(*) END AS fraud_rate FROM feat WHERE {column} IS NOT NULL
GROUP BY {column}""", ["fraud_rate"])


def crosstab_sql(column: str) -> str:
    return sql(FEAT, f"""SELECT {column}, sum(1 - is_fraud)::DOUBLE / count(*) AS share_0,
  sum(is_fraud)::DOUBLE / count(*) AS share_1 FROM feat WHERE {column} IS NOT NULL GROUP BY {column}""",
               ["share_0", "share_1"])


def _positive_counts() -> str:
    from cardwatch.operators.eda import COUNT_DIMENSIONS, COUNT_ORDER

    counted = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS n "
        f"FROM feat WHERE is_fraud = 1 AND {d} IS NOT NULL GROUP BY {d}" for d in COUNT_DIMENSIONS
    )
    slots = ", ".join(
        f"('{d}', '{v}', {i})" for d, values in COUNT_ORDER.items() for i, v in enumerate(values)
    )
    return sql(f"{FEAT}, counted AS ({counted}), slots(dimension, value, position) AS (VALUES {slots})",
               "SELECT dimension, value, position, coalesce(n, 0) AS n "
               "FROM counted FULL JOIN slots USING (dimension, value)")


def _balance(source: str, columns: str = "*") -> str:
    return f"""SELECT {columns} FROM (SELECT *, {ratio('1 - positive_rate', 'positive_rate')} AS imbalance_ratio,
  {ratio('n_negative', 'n_positive')} AS scale_pos_weight FROM (
  SELECT count(is_fraud) AS n, count(*) FILTER (WHERE is_fraud = 0) AS n_negative,
    count(*) FILTER (WHERE is_fraud = 1) AS n_positive, avg(is_fraud) AS positive_rate FROM {source}))"""


def _missing(source: str, columns: dict[str, str]) -> str:
    def test(c, kind):
        return f"{c} IS NULL OR isnan({c})" if kind == "double" else f"{c} IS NULL"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {test(c, k)}) AS missing FROM {source}"
        for c, k in columns.items()
    )


def _quality() -> str:
    def row(name, source, columns, label):
        rate = "avg(is_fraud)" if label else "avg(NULL::DOUBLE)"
        return f"""SELECT '{name}' AS dataset,
  CAST((SELECT sum(missing) FROM ({_missing(source, columns)})) AS BIGINT) AS missing_values,
  (SELECT (SELECT count(*) FROM {source}) - count(*) FROM (SELECT DISTINCT {', '.join(columns)} FROM {source})) AS duplicates,
  {rate} AS fraud_rate FROM {source}"""

    unlabelled = {c: k for c, k in TX_COLUMNS.items() if c != "is_fraud"}
    body = " UNION ALL ".join([
        row("train", "train", TX_COLUMNS, True), row("test", "test", unlabelled, False),
        row("with_gaps", "gaps", GAP_COLUMNS, True),
    ])
    return sql(f"{GAPS}, train AS (SELECT * FROM transactions WHERE split = 'train'), "
               "test AS (SELECT * FROM transactions WHERE split = 'test')", body, ["fraud_rate"])


def _distinct() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
        f"count(DISTINCT {c}) = count(*) AS is_key, count(DISTINCT {c}) <= 1 AS is_constant "
        f"FROM transactions" for c, k in TX_COLUMNS.items() if k != "string"
    )
    return sql(TX, parts)


def _info() -> str:
    return sql(GAPS, " UNION ALL ".join(
        f"SELECT {i}::BIGINT AS position, '{c}' AS \"column\", '{k}' AS type, count({c}) AS non_null FROM gaps"
        for i, (c, k) in enumerate(GAP_COLUMNS.items())
    ))


def _broken(day: int) -> str:
    return f"""{TX}, raw AS (SELECT id,
  CASE WHEN id % 50 = 0 THEN NULL ELSE trans_date_trans_time END AS trans_date_trans_time,
  CASE WHEN id % {day} = 1 THEN NULL ELSE dob END AS dob FROM transactions)"""


def _state_codes() -> tuple[str, int]:
    codes = sorted({s for states in feat.CENSUS_REGIONS.values() for s in states} | {"CA", "WA"})
    return "[" + ", ".join(f"'{c}'" for c in codes) + "]", len(codes)


def _region(regions) -> str:
    return "CASE " + " ".join(
        "WHEN state IN ({}) THEN '{}'".format(", ".join(f"'{s}'" for s in states), name)
        for name, states in regions.items()
    ) + " ELSE 'West' END"


def _roc(by: str | None, drop: bool, source: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    where = "WHERE is_first OR next0 IS NULL OR next0 <> n0 OR next1 <> n1" if drop else ""
    ctes = f"""{SCORES}, chosen AS (SELECT * FROM {source}),
steps AS (SELECT {keys}score, sum(label) AS n1, sum(1 - label) AS n0 FROM chosen GROUP BY {keys}score),
cum AS (SELECT *, sum(n1) OVER w AS c1, sum(n0) OVER w AS c0, lead(n0) OVER w AS next0, lead(n1) OVER w AS next1,
  row_number() OVER w = 1 AS is_first,
  sum(n1) OVER ({part}) AS all1, sum(n0) OVER ({part}) AS all0 FROM steps
  WINDOW w AS ({part} ORDER BY score DESC))"""
    origin = f"SELECT DISTINCT {keys}'Infinity'::DOUBLE AS threshold, 0.0e0 AS fpr, 0.0e0 AS tpr FROM chosen"
    body = (f"SELECT {keys}score AS threshold, {ratio('c0', 'all0')} AS fpr, {ratio('c1', 'all1')} AS tpr "
            f"FROM cum {where} UNION ALL {origin}")
    fixed = ["fpr", "tpr"]
    return sql(ctes, body, fixed)


def _ids(columns: str, source: str = "feat") -> str:
    return sql(FEAT, f"SELECT id, {columns} FROM {source}")


def _linear_shap() -> tuple[str, str]:
    means = ", ".join(f"avg({c}::DOUBLE) AS m_{c}" for c in cat.LINEAR)
    base = linear({f"m_{c}": w for c, w in cat.LINEAR.items()}, cat.LINEAR_INTERCEPT)
    rows = " UNION ALL ".join(
        f"SELECT id, '{c}' AS feature, {w!r}::DOUBLE * ({c}::DOUBLE - m_{c}) AS phi, {base} AS base FROM feat, means"
        for c, w in cat.LINEAR.items()
    )
    return (f"{FEAT}, means AS (SELECT {means} FROM (SELECT * FROM feat ORDER BY id LIMIT 100)), "
            f"shap AS ({rows})"), "shap"


def _scored_linear() -> str:
    p = f"1.0e0 / (1.0e0 + exp(-{linear(cat.LINEAR, cat.LINEAR_INTERCEPT)}))"
    return f"""{FEAT}, p AS (SELECT id, {p} AS fraud_probability FROM feat),
scored AS (SELECT id, fraud_probability >= 0.5 AS is_fraud, fraud_probability,
  CASE WHEN fraud_probability < 0.3 THEN 'LOW' WHEN fraud_probability < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level
FROM p)"""


def _boosting_round() -> str:
    """Rate 0.3, L1 2, L2 5, least hessian 1, margin 0; the positive class weighs negatives / positives."""
    columns = ["amt_band", "trans_hour", "trans_month", "trans_weekday", "is_weekend", "is_night", "gender_encoded"]
    values = "[" + ", ".join(f"{{'c': {i}, 'v': CAST({c} AS BIGINT)}}" for i, c in enumerate(columns)) + "]"
    shrunk = lambda g: f"sign({g}) * greatest(abs({g}) - 2.0e0, 0)"
    part = lambda g, h: f"power({shrunk(g)}, 2) / ({h} + 5.0e0)"
    leaf = lambda g, h: f"-0.3e0 * {shrunk(g)} / ({h} + 5.0e0)"
    return sql(f"""{FEAT}, banded AS (SELECT *, floor(amt / 25) AS amt_band FROM feat),
weighed AS (SELECT *, CASE WHEN is_fraud = 1 THEN (SELECT sum(1 - is_fraud) / sum(is_fraud)::DOUBLE FROM banded WHERE split = 'train')
  ELSE 1.0e0 END AS w FROM banded WHERE split = 'train'),
cells AS (SELECT x.c AS c, x.v AS v, sum((0.5e0 - is_fraud) * w) AS g, sum(0.25e0 * w) AS h
  FROM (SELECT is_fraud, w, unnest({values}) AS x FROM weighed) GROUP BY 1, 2),
below AS (SELECT c, v, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl, sum(g) OVER whole - sum(g) OVER upto AS gr,
    sum(h) OVER whole - sum(h) OVER upto AS hr, sum(g) OVER whole AS g, sum(h) OVER whole AS h
  FROM cells WINDOW upto AS (PARTITION BY c ORDER BY v), whole AS (PARTITION BY c)),
best AS (SELECT *, {part('gl', 'hl')} + {part('gr', 'hr')} - {part('g', 'h')} AS gain FROM below
  WHERE hl >= 1 AND hr >= 1 ORDER BY gain DESC, c, v LIMIT 1),
scored AS (SELECT id, is_fraud AS label, 1.0e0 / (1.0e0 + exp(-(CASE WHEN {values}[c + 1].v <= v THEN {leaf('gl', 'hl')} ELSE {leaf('gr', 'hr')} END))) AS score
  FROM banded, best WHERE split = 'test')""",
               "SELECT id, label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored", ["score"], 9)


def _stump() -> str:
    """The cut of least summed Gini impurity with balanced classes, and the positive share on either side."""
    columns = ["amt_band", "trans_hour", "trans_month", "trans_weekday", "is_weekend", "is_night", "gender_encoded"]
    values = "[" + ", ".join(f"{{'c': {i}, 'v': CAST({c} AS BIGINT)}}" for i, c in enumerate(columns)) + "]"
    return sql(f"""{FEAT}, banded AS (SELECT *, floor(amt / 25) AS amt_band FROM feat),
weighed AS (SELECT *, count(*) OVER () / (2.0e0 * count(*) OVER (PARTITION BY is_fraud)) AS w FROM banded WHERE split = 'train'),
cells AS (SELECT x.c AS c, x.v AS v, sum(w) AS n, sum(is_fraud * w) AS n1
  FROM (SELECT is_fraud, w, unnest({values}) AS x FROM weighed) GROUP BY 1, 2),
below AS (SELECT c, v, sum(n) OVER upto AS nl, sum(n1) OVER upto AS pl, sum(n) OVER whole - sum(n) OVER upto AS nr,
    sum(n1) OVER whole - sum(n1) OVER upto AS pr
  FROM cells WINDOW upto AS (PARTITION BY c ORDER BY v), whole AS (PARTITION BY c)),
best AS (SELECT c, v, pl::DOUBLE / nl AS l, pr::DOUBLE / nr AS r FROM below WHERE nr > 0.1
  ORDER BY pl::DOUBLE * (nl - pl) / nl + pr::DOUBLE * (nr - pr) / nr, c, v LIMIT 1),
scored AS (SELECT id, is_fraud AS label, CASE WHEN {values}[c + 1].v <= v THEN l ELSE r END AS score
  FROM banded, best WHERE split = 'test')""",
               "SELECT id, label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored", ["score"], 9)


def _exact_tree(depth: int) -> str:
    """Every level tries all cuts between neighbouring values of every node; classes are balanced."""
    values = "[" + ", ".join(f"{{'c': {i}, 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(cat.EXACT_COLUMNS)) + "]"
    half = lambda a, b: f"coalesce({a} * {b} / nullif({a} + {b}, 0), 0)"
    ctes = f"""{FEAT}, weights AS (SELECT count(*) / (2.0e0 * sum(1 - is_fraud)) AS w0, count(*) / (2.0e0 * sum(is_fraud)) AS w1
  FROM feat WHERE split = 'train'), at0 AS (SELECT id, split, is_fraud, {values} AS x, 1 AS node FROM feat)"""
    for d in range(depth):
        ctes += f""",
cells{d} AS (SELECT node, u.c AS c, u.v AS v, sum(1 - is_fraud)::DOUBLE AS n0, sum(is_fraud)::DOUBLE AS n1
  FROM (SELECT node, is_fraud, unnest(x) AS u FROM at{d} WHERE split = 'train') GROUP BY ALL),
below{d} AS (SELECT node, c, v, lead(v) OVER upto AS after, sum(n0) OVER upto * w0 AS a, sum(n1) OVER upto * w1 AS b,
    (sum(n0) OVER whole - sum(n0) OVER upto) * w0 AS p, (sum(n1) OVER whole - sum(n1) OVER upto) * w1 AS q,
    sum(n0) OVER whole AS t0, sum(n1) OVER whole AS t1
  FROM cells{d}, weights WINDOW upto AS (PARTITION BY node, c ORDER BY v), whole AS (PARTITION BY node, c)),
best{d} AS (SELECT node, c, (v + after) / 2 AS cut FROM below{d} WHERE after IS NOT NULL AND t0 > 0 AND t1 > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY {half('a', 'b')} + {half('p', 'q')}, c, v) = 1),
at{d + 1} AS (SELECT id, split, is_fraud, x, CASE WHEN cut IS NULL THEN node WHEN x[c + 1].v <= cut THEN 2 * node ELSE 2 * node + 1 END AS node
  FROM at{d} LEFT JOIN best{d} USING (node))"""
    return sql(ctes + f""",
leaves AS (SELECT node, sum(is_fraud) * any_value(w1) / (sum(1 - is_fraud) * any_value(w0) + sum(is_fraud) * any_value(w1)) AS score
  FROM at{depth}, weights WHERE split = 'train' GROUP BY node),
scored AS (SELECT id, is_fraud AS label, score FROM at{depth} JOIN leaves USING (node) WHERE split = 'test')""",
               "SELECT id, label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored", ["score"], 9)


def oracle() -> dict[str, str]:
    tx = ", ".join(TX_COLUMNS)
    shap_ctes, shap = _linear_shap()
    lower = [(b, a) for a, b in combinations(cat.CORRELATED, 2)]
    full = [(a, b) for a in cat.CORRELATED for b in cat.CORRELATED]
    with_label = [(c, "is_fraud") for c in cat.CORRELATED if c != "is_fraud"]
    numeric = [c for c in FEATURES if c not in CATEGORICAL]
    pair_names = list(combinations(["amt", "age", "trans_hour", "city_pop"], 2))
    codes, n_codes = _state_codes()
    defaulted = [c for c in REQUEST_DEFAULTS if c not in ("is_weekend", "gender_encoded")]
    modelled = [c for c in FEATURES]
    dropped = [c for c in [
        *TX_COLUMNS, "trans_month", "trans_day", "trans_hour", "trans_weekday", "quarter",
        "is_weekend", "is_night", "is_business_hours", "is_holiday_season", "is_tax_season",
        "hour_sin", "hour_cos", "month_sin", "month_cos", "age", "gender_encoded", "age_group",
        "city_pop_category", "distance_km", "is_distant_transaction",
    ] if c not in NOT_MODELLED]
    cyclic = ["hour_sin", "hour_cos", "month_sin", "month_cos"]
    out = {
        "s_load": sql(TX, f"SELECT {tx} FROM transactions"),
        "s_parse": sql(_broken(50), "SELECT * FROM raw"),
        "s_parse_failures": sql(
            _broken(70), "SELECT 'trans_date_trans_time' AS \"column\", count(*) - count(trans_date_trans_time) AS failed FROM raw "
                     "UNION ALL SELECT 'dob', count(*) - count(dob) FROM raw"),
        "s_quarantine": sql(TX, """SELECT id, CASE WHEN bad THEN 'bad' ELSE 'good' END AS status,
  CASE WHEN NOT bad THEN amt END AS amt, CASE WHEN NOT bad THEN city_pop END AS city_pop
FROM (SELECT *, id % 97 = 0 OR id % 89 = 0 AS bad FROM transactions)"""),
        "s_model_roundtrip": sql(TX, "SELECT id, true AS same FROM transactions WHERE split = 'test'"),
        "s_summary": sql(TEST_RESULTS, f"""SELECT *, 'formula' AS model_type, 20 AS num_features,
  false AS scaler_available, model = (SELECT model FROM ({COMPARISON}) ORDER BY score DESC, model LIMIT 1) AS is_best,
  'run-1' AS run_id FROM ({COMPARISON})""", COMPARISON_FLOATS),
        "s_registry_log": sql(f"{SCORES}, {metrics_ctes('scores', 'split, model')}", " UNION ALL ".join(
            f"""SELECT *, 'formula' AS model_type, 20 AS num_features, false AS scaler_available, model = '{best}' AS is_best,
  '{run}' AS run_id, CAST({runs} AS BIGINT) AS runs FROM ({COMPARISON} WHERE split = '{part}' AND model IN ({models}))"""
            for best, run, runs, part, models in (
                ("logistic_regression", "run-1", 1, "train", "'logistic_regression'"),
                ("random_forest", "run-2", 2, "test", "'random_forest', 'gradient_boosting'"))), COMPARISON_FLOATS),
        "s_batch_score": sql(_scored_linear(), "SELECT * FROM scored", ["fraud_probability"]),
        "q_shape": sql(TX, """SELECT dataset, n_rows, 15::BIGINT AS n_columns,
  n_rows::DOUBLE / (SELECT count(*) FROM transactions WHERE split = 'train') AS share_of_first FROM (
  SELECT split AS dataset, count(*) AS n_rows FROM transactions GROUP BY split)""", ["share_of_first"]),
        "q_missing": sql(GAPS, _missing("gaps", GAP_COLUMNS)),
        "q_duplicates": sql(TX, """SELECT (SELECT count(*) FROM transactions) - count(*) AS duplicates FROM (
  SELECT DISTINCT cc_num, category, CASE WHEN cc_num % 3 = 0 THEN NULL ELSE state END FROM transactions)"""),
        "q_fraud_rate": sql(TX, _balance("transactions"), ["positive_rate", "imbalance_ratio", "scale_pos_weight"]),
        "q_quality_report": _quality(),
        "q_distinct": _distinct(),
        "q_value_counts": sql(GAPS, "SELECT category, count(*) AS n FROM gaps WHERE category IS NOT NULL GROUP BY category"),
        "q_value_counts_sorted": sql(FEAT, "SELECT age, count(*) AS n FROM feat GROUP BY age"),
        "q_describe": describe_sql("amt", None),
        "q_describe_by_class": describe_sql("distance_km", "is_fraud"),
        "q_info": _info(),
        "q_share": sql(FEAT, """SELECT period_of_day, count(*) AS n,
  count(*) * 100.0e0 / (SELECT count(*) FROM feat) AS percent FROM feat GROUP BY period_of_day""", ["percent"]),
        "q_preview": sql(TX, "SELECT * FROM transactions ORDER BY id LIMIT 10"),
        "p_drop": sql(FEAT, f"SELECT {', '.join(dropped)} FROM feat",
                      [c for c in dropped if c in ("amt", *cyclic)]),
        "p_class_filter": sql(TX, "SELECT * FROM transactions WHERE is_fraud = 1"),
        "p_select_types": sql(TX, "SELECT id, cc_num, amt, lat, long, city_pop, merch_lat, merch_long, is_fraud FROM transactions"),
        "p_select_text": sql(TX, "SELECT id, merchant, category, gender, state, split FROM transactions"),
        "p_align": sql(TX, """SELECT id, amt, city_pop, 0.0e0 AS lat, is_fraud, 'train' AS part FROM transactions WHERE split = 'train'
UNION ALL SELECT id, amt, 0::BIGINT, lat, NULL::INTEGER, 'test' FROM transactions WHERE split = 'test'"""),
        "p_xy": _ids("amt AS x0, age::DOUBLE AS x1, trans_hour::DOUBLE AS x2, city_pop::DOUBLE AS x3, "
                     "CASE WHEN split = 'train' THEN is_fraud::DOUBLE END AS label"),
        "p_threshold": sql(SCORES, "SELECT id, model, prediction FROM scores"),
        "p_request_fill": _ids(", ".join(
            c if c in ("amt", "trans_hour", "trans_month", "age", "city_pop") else f"0 AS {c}" for c in FEATURES)),
        "p_request_defaults": _ids(
            "amt, trans_hour, trans_month, age, city_pop, CASE WHEN id % 2 = 0 THEN is_weekend ELSE 0 END AS is_weekend, "
            "CASE WHEN id % 3 = 0 THEN gender_encoded ELSE 0 END AS gender_encoded, "
            + ", ".join(f"0 AS {c}" for c in defaulted)),
        "j_assign_by_key": sql(TX, "SELECT id, amt, CASE WHEN split = 'train' THEN dob END AS train_dob FROM transactions"),
        "j_coef_table": sql(
            ascent(gradient.PENALTIES) + f", long AS ({_ascent_long(gradient.PENALTIES)})",
            "SELECT feature, " + ", ".join(
                f"max(coefficient) FILTER (WHERE penalty = {p!r}) AS penalty_{p:g}" for p in gradient.PENALTIES)
            + " FROM long GROUP BY feature", [f"penalty_{p:g}" for p in gradient.PENALTIES], 9),
        "j_knn": sql(f"{FEAT}, minority AS (SELECT * FROM feat WHERE split = 'train' AND is_fraud = 1)",
                     neighbours("minority", cat.NEIGHBOUR_COLUMNS), ["distance2"], 3),
        "j_dictionary": sql(f"""{TX}, codes AS (SELECT merchant, CAST(row_number() OVER (ORDER BY merchant) - 1 AS INTEGER) AS merchant_code
  FROM (SELECT DISTINCT merchant FROM transactions))""",
                            "SELECT id, merchant, merchant_code FROM transactions JOIN codes USING (merchant) WHERE split = 'test'"),
        "a_rate_hour": rate_sql("trans_hour"),
        "a_rate_month": rate_sql("trans_month"),
        "a_rate_age": crosstab_sql("age_group"),
        "a_rate_gender": crosstab_sql("gender"),
        "a_fraud_counts": _positive_counts(),
        "a_hist_density": histogram_sql("amt", "is_fraud", True),
        "a_hist_distance": histogram_sql("distance_km", "is_fraud", True),
        "a_hist_count": histogram_sql("amt", None, False),
        "a_kde": sql(f"""{TX}, s AS (SELECT count(*) AS n, min(amt) AS lo, max(amt) AS hi,
  pow(count(*)::DOUBLE, -0.2e0) * stddev_samp(amt) AS h FROM transactions),
grid AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS point, * FROM s),
points AS (SELECT *, lo + point * ((hi - lo) / 199) AS x FROM grid)""",
                     """SELECT point, any_value(x) AS x,
  sum(exp(-0.5e0 * ((x - amt) / h) * ((x - amt) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
FROM points, transactions GROUP BY point""", ["x", "density"], 9),
        "a_corr": sql(*_corr_pairs(full), ["r"]),
        "a_corr_lower": sql(*_corr_pairs(lower), ["r"]),
        "a_vif": vif_sql(),
        "a_class_ratio": sql(f"{TX}, train AS (SELECT * FROM transactions WHERE split = 'train')",
                             _balance("train", "n_negative, n_positive, scale_pos_weight"), ["scale_pos_weight"]),
        "t_top_features": sql(_corr_pairs(with_label)[0] + f", strength AS ({_corr_pairs(with_label)[1]})",
                              "SELECT column_a AS feature, round(abs(r), 6) AS importance FROM strength "
                              "ORDER BY importance DESC, feature LIMIT 20", ["importance"]),
        "t_argmax": sql(TEST_RESULTS, f"SELECT model, score FROM ({COMPARISON}) ORDER BY score DESC, model LIMIT 1", ["score"]),
        "t_first_n": sql(TX, "SELECT * FROM transactions ORDER BY id LIMIT 200"),
        "u_union_all": sql(TX, f"SELECT {tx} FROM transactions UNION ALL SELECT {tx} FROM transactions WHERE split = 'train' AND is_fraud = 1"),
        "f_temporal": _ids("trans_month, trans_day, trans_hour, trans_weekday, quarter"),
        "f_flags": _ids("is_weekend, is_night, is_business_hours, is_holiday_season, is_tax_season"),
        "f_cyclic": sql(FEAT, f"SELECT id, {', '.join(cyclic)} FROM feat", cyclic),
        "f_period_of_day": _ids("period_of_day"),
        "f_age": _ids("age"),
        "f_age_group": _ids("age_group"),
        "f_age_group_nb": _ids("age_band"),
        "f_gender": _ids("gender_encoded, gender_flag"),
        "f_city_pop": _ids("city_pop_category, city_pop_group"),
        "f_distance": sql(FEAT, "SELECT id, distance_km, is_distant_transaction FROM feat", ["distance_km"]),
        "f_region": sql(f"{TX}, named AS (SELECT id, {codes}[cc_num % {n_codes} + 1] AS state FROM transactions)",
                        f"SELECT id, state, {_region(feat.REGIONS)} AS state_region, {_region(feat.CENSUS_REGIONS)} AS census_region FROM named"),
        "f_interactions": sql(FEAT, "SELECT id, " + ", ".join(
            f"{a} * {b} AS {a}_x_{b}" for a, b in pair_names) + " FROM feat"),
        "f_sigmoid": sql(_scored_linear(), "SELECT id, fraud_probability AS p FROM scored", ["p"]),
        "f_risk": sql(SCORES, "SELECT id, model, CASE WHEN score < 0.3 THEN 'LOW' WHEN score < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM scores"),
        "f_composite": sql(TEST_RESULTS, f"SELECT model, score FROM ({COMPARISON})", ["score"]),
        "f_model_name": sql(f"{SCORES}, counts AS (SELECT model, count(*) AS n FROM scores GROUP BY model)",
                            "SELECT n, array_to_string(list_transform(string_split(model, '_'), lambda w: upper(w[1]) || w[2:]), ' ') AS name, model AS key FROM counts"),
        "f_round": sql(TEST_RESULTS, "SELECT model, " + ", ".join(
            f"round_even({c}, 4) AS {c}" for c in ("accuracy", "precision", "recall", "f1", "auc")) + " FROM results"),
        "m_label_encode": sql(CODED, f"SELECT id, {', '.join(CATEGORICAL)} FROM coded"),
        "m_one_hot": sql(TX, "SELECT id, " + ", ".join(
            f"CASE WHEN category = '{v}' THEN 1 ELSE 0 END AS \"category_{v}\"" for v in _DUMMIES.values()) + " FROM transactions"),
        "m_scale": sql(f"{FEAT}, fitted AS (SELECT " + ", ".join(
            f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in cat.COMPACT_SCALED)
            + " FROM feat WHERE split = 'train')",
            "SELECT id, split, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in cat.COMPACT_SCALED) + " FROM feat, fitted",
            cat.COMPACT_SCALED),
        "m_smote": sql(SMOTE, f"""SELECT d AS draw, a.id AS base_id, b.id AS neighbour_id, {_smote_columns()}
FROM picks JOIN minority a ON a.rn = pick // 5 JOIN near ON near.id = a.id AND near.rank = pick % 5 + 1
JOIN minority b ON b.id = near.neighbour_id""", _REAL),
        "m_bootstrap": sql(f"{TX}, {BOOT}", "SELECT draw, minority.* EXCLUDE (rn) FROM draws JOIN minority USING (rn)"),
        "m_class_weight": sql(f"{TX}, train AS (SELECT * FROM transactions WHERE split = 'train')",
                              "SELECT is_fraud, count(*) AS n, (SELECT count(*) FROM train) / (2.0e0 * count(*)) AS weight FROM train GROUP BY is_fraud", ["weight"]),
        "m_folds": sql(f"{TX}, train AS (SELECT * FROM transactions WHERE split = 'train')", folds("train", 5, "id, is_fraud")),
        "m_fold_split": sql(f"""{TX}, train AS (SELECT * FROM transactions WHERE split = 'train'),
folded AS ({folds('train', 3, 'id, is_fraud')}), turns AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS turn)""",
                            """SELECT turn AS fold, CASE WHEN fold = turn THEN 'validation' ELSE 'train' END AS part, count(*) AS n,
  CAST(sum(is_fraud) AS BIGINT) AS n1 FROM folded, turns GROUP BY 1, 2"""),
        "m_assemble": sql(CODED, "SELECT id, " + ", ".join(
            f"{c}::DOUBLE AS v{i:02d}" for i, c in enumerate(FEATURES)) + " FROM coded WHERE split = 'train'",
            [f"v{i:02d}" for i in range(len(FEATURES))]),
        "m_model_table": sql(CODED, f"SELECT {', '.join(modelled)}, is_fraud, split AS part FROM coded", ["amt", *cyclic]),
        "e_grad_ascent": sql(ascent([4.0]) + f", long AS ({_ascent_long([4.0])})", "SELECT * FROM long", ["coefficient"], 9),
        "m_one_hot_vector": sql(f"""{TX}, codes AS (SELECT merchant, row_number() OVER (ORDER BY merchant) - 1 AS code
  FROM (SELECT DISTINCT merchant FROM transactions WHERE split = 'train'))""",
            """SELECT id, CAST((SELECT count(*) - 1 FROM codes) AS INT) AS size, coalesce(code - 1, -1) AS place
FROM transactions LEFT JOIN codes USING (merchant) WHERE split = 'test'"""),
        "e_boosting_round": _boosting_round(),
        "e_tree_stump": _stump(),
        "e_exact_depth3": _exact_tree(3),
        "e_exact_leaves": sql(f"""{FEAT}, banded AS (SELECT *, floor(amt / 25) AS amt_band FROM feat WHERE split = 'train'),
scored AS (SELECT id, is_fraud AS label, avg(is_fraud::DOUBLE) OVER (PARTITION BY {", ".join(cat.ROUND_COLUMNS)}) AS score FROM banded)""",
                              "SELECT id, label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored", ["score"], 9),
        "e_lr_dummies": sql(f"""{FEAT}, rates AS (SELECT period_of_day, avg(is_fraud::DOUBLE) AS score
  FROM feat WHERE split = 'train' GROUP BY 1)""",
            """SELECT id, is_fraud AS label, score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction
FROM feat JOIN rates USING (period_of_day) WHERE split = 'test'""", ["score"], 5),
        "e_loglik": sql(FEAT, f"""SELECT sum((is_fraud - 1) * s - CASE WHEN s >= 0 THEN ln(1 + exp(-s)) ELSE ln(1 + exp(s)) - s END)
  - 10.0e0 * ({' + '.join(f'{w!r}::DOUBLE * {w!r}::DOUBLE' for c, w in cat.LINEAR.items() if c != 'amt')}) AS log_likelihood
FROM (SELECT is_fraud, {linear(cat.LINEAR)} AS s FROM feat WHERE split = 'train')""", ["log_likelihood"], 4),
        "e_l2_sweep": sql(ascent(gradient.PENALTIES) + f""",
test AS (SELECT is_fraud AS label, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in ASCENT_COLUMNS)} FROM (
  SELECT is_fraud, split, {', '.join(cat.ASCENT_BASE)}, {', '.join(f"CASE WHEN category = '{v}' THEN 1 ELSE 0 END AS {d}" for d, v in _DUMMIES.items())}
  FROM feat WHERE split = 'test'), fitted),
guessed AS (SELECT penalty, label, CASE WHEN 1.0e0 / (1.0e0 + exp(-({' + '.join(f't.{c} * w.{c}' for c in ASCENT_COLUMNS)}))) >= 0.5 THEN 1 ELSE 0 END AS prediction
  FROM test t, {_LAST} w),
confusion AS (SELECT penalty, {CONFUSION} FROM guessed GROUP BY penalty)""", report("confusion", "penalty"), ["precision", "recall", "f1"]),
        "v_confusion": sql(SCORES, f"SELECT model, {CONFUSION} FROM scores GROUP BY model"),
        "v_metrics": sql(f"{SCORES}, {metrics_ctes('scores', 'model')}", "SELECT * FROM rates", ["accuracy", "precision", "recall", "f1"]),
        "v_auc": sql(f"{SCORES}, {metrics_ctes('scores', 'model')}", "SELECT * FROM areas", ["auc"]),
        "v_roc": _roc(None, True, "scores WHERE model = 'random_forest'"),
        "v_report": sql(f"{SCORES}, confusion AS (SELECT model, {CONFUSION} FROM scores GROUP BY model)",
                        report("confusion", "model"), ["precision", "recall", "f1"]),
        "v_fold_metrics": sql(f"""{SCORES}, folded AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {u('id', 42)}, id) - 1) % 5 AS INTEGER) AS fold
  FROM scores WHERE model = 'random_forest'), {metrics_ctes('folded', 'fold')}""", "SELECT fold, f1, auc FROM results", ["f1", "auc"]),
        "v_compare": sql(TEST_RESULTS, COMPARISON, COMPARISON_FLOATS),
        "v_best": sql(TEST_RESULTS, f"SELECT * FROM ({COMPARISON}) ORDER BY score DESC, model LIMIT 1", COMPARISON_FLOATS),
        "v_roc_all": _roc("model", False, "scores"),
        "v_overfit": sql(f"{SCORES}, parts AS (SELECT *, {RATES} FROM (SELECT model, split, {CONFUSION} FROM scores GROUP BY model, split))",
                         "SELECT tr.model, " + ", ".join(
                             f"tr.{m} AS train_{m}, te.{m} AS test_{m}, tr.{m} - te.{m} AS gap_{m}" for m in ("accuracy", "precision", "recall", "f1"))
                         + " FROM parts tr JOIN parts te ON tr.model = te.model AND tr.split = 'train' AND te.split = 'test'",
                         [f"{p}_{m}" for m in ("accuracy", "precision", "recall", "f1") for p in ("train", "test", "gap")]),
        "v_type2": sql(f"{SCORES}, confusion AS (SELECT model, {CONFUSION} FROM scores GROUP BY model)",
                       f"SELECT model, fn AS false_negatives, {ratio('fn', 'tn + fp + fn + tp')} AS type2_share FROM confusion", ["type2_share"]),
        "v_threshold": sql(f"""{SCORES}, grid AS (SELECT unnest({cat.THRESHOLDS})::DOUBLE AS threshold),
swept AS (SELECT model, threshold, label, CASE WHEN score >= threshold THEN 1 ELSE 0 END AS prediction FROM scores, grid)""",
                           f"SELECT *, {RATES} FROM (SELECT model, threshold, {CONFUSION} FROM swept GROUP BY model, threshold)",
                           ["threshold", "accuracy", "precision", "recall", "f1"]),
        "x_linear_shap": sql(shap_ctes, f"SELECT * FROM {shap}", ["phi", "base"]),
        "x_shap_summary": sql(shap_ctes, f"SELECT feature, avg(abs(phi)) AS mean_abs_phi FROM {shap} GROUP BY feature", ["mean_abs_phi"]),
        "d_preprocess": sql(f"{FEAT}, fitted AS (SELECT " + ", ".join(
            f"avg({c}::DOUBLE) AS m_{c}, stddev_pop({c}::DOUBLE) AS s_{c}" for c in numeric) + " FROM feat WHERE split = 'train')",
            "SELECT id, " + ", ".join(
                f"({c if c in ('amt', 'trans_hour', 'trans_month', 'age', 'city_pop') else 0} - m_{c}) / s_{c} AS {c}" for c in numeric)
            + " FROM feat, fitted WHERE split = 'test'", numeric),
        "d_score": sql(_scored_linear(), "SELECT * FROM scored", ["fraud_probability"]),
        "d_stream_score": sql("""p AS (SELECT event_id, 1.0e0 / (1.0e0 + exp(-(-2.0e0 + 0.02e0 * value + 0.05e0 * hour(ts)))) AS fraud_probability FROM events)""",
                              """SELECT event_id, fraud_probability >= 0.5 AS is_fraud, fraud_probability,
  CASE WHEN fraud_probability < 0.3 THEN 'LOW' WHEN fraud_probability < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level FROM p""", ["fraud_probability"]),
        "d_risk_summary": sql(_scored_linear(), """SELECT risk_level, count(*) AS n, avg(fraud_probability) AS mean_probability,
  count(*)::DOUBLE / (SELECT count(*) FROM scored) AS share FROM scored GROUP BY risk_level""", ["mean_probability", "share"]),
        "d_stream_rate": sql("hours AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n, "
                             "count(*) FILTER (WHERE value > 100) AS n_flagged FROM events WHERE ts IS NOT NULL GROUP BY 1)",
                             "SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n, n_flagged, n_flagged::DOUBLE / n AS rate "
                             "FROM hours", ["rate"]),
        "d_stream_rate_final": sql("hours AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n, "
                             "count(*) FILTER (WHERE value > 100) AS n_flagged FROM events GROUP BY 1)",
                             """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n, n_flagged, n_flagged::DOUBLE / n AS rate
FROM hours WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""", ["rate"]),
    }
    return out
