"""Forecasts, anomalies and valuation over the home-sales tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelmill.constants import (
    DRIVER_TOP, FORECAST_HOLDOUT, FORECAST_NORMAL_QUANTILE, FORECAST_STEPS, FOREST_BAG, FOREST_EXAMPLES, FOREST_FEATURES, FOREST_SEED, FOREST_SHARE, FOREST_TREES,
    VALUE_BOOLEAN, VALUE_CATEGORY, VALUE_NUMERIC,
)
from parcelmill.operators import attribution, calendar, forecast as fc, isolation, valuation
from parcelmill.plans import stages
from parcelmill.plans.market_queries import county_kpi
from parcelmill.plans.registry import query
from parcelmill.plans.views import rate_rows
from parcelmill.session import is_staged, stage, staged_path
from parcelmill.sources import rates, sinks

_KEYS = ["market", "metric"]


# --- forecasts -------------------------------------------------------------

def county_series(spark, folder):
    return calendar.as_series(county_kpi(spark, folder), ["median_close_price", "closed_sales"])


@query("series_unpivot", """
SELECT g.market, metric, strftime(month, '%Y-%m-%d') AS month,
  round(CASE metric WHEN 'closed_sales' THEN k.closed_sales ELSE k.median_close_price END, 4) AS value
FROM (SELECT market, unnest(generate_series(a, z, INTERVAL 1 month)) AS month
  FROM (SELECT market, min(cast(yr_mo || '-01' AS date)) AS a, max(cast(yr_mo || '-01' AS date)) AS z
    FROM county_kpi GROUP BY market) s) g
CROSS JOIN (SELECT unnest(['median_close_price', 'closed_sales']) AS metric) m
LEFT JOIN county_kpi k ON k.market = g.market AND k.yr_mo = strftime(month, '%Y-%m')""", needs=("county_kpi",))
def series_unpivot(spark, folder):
    return county_series(spark, folder)


# The whole fit in SQL: the seasonal one from sums of products, round by round,
# the plain one on the same grids; then the values and their intervals.
_SERIES_SQL = """
SELECT g.market, metric, month, CASE metric WHEN 'closed_sales' THEN k.closed_sales ELSE k.median_close_price END AS v
FROM (SELECT market, unnest(generate_series(a, z, INTERVAL 1 month)) AS month
  FROM (SELECT market, min(cast(yr_mo || '-01' AS date)) AS a, max(cast(yr_mo || '-01' AS date)) AS z
    FROM county_kpi GROUP BY market) s) g
CROSS JOIN (SELECT unnest(['median_close_price', 'closed_sales']) AS metric) m
LEFT JOIN county_kpi k ON k.market = g.market AND k.yr_mo = strftime(month, '%Y-%m')"""
_OF = "PARTITION BY market, metric ORDER BY"


def _slope_sql(product: str, power: str) -> str:
    return f"CASE WHEN {power} > 0 THEN ({product}) / ({power}) ELSE 0 END"


def _grid_sql(turn: int) -> str:
    """The best point of the grid around the best point before."""
    width = 0.95
    for _ in range(turn):
        width /= 5

    def axis(c, i):
        return f"least(greatest(p.{c} + ({-width!r} + {i} * {2 * width / 20!r}), -0.98), 0.98)"

    shock = "d.w - a * before - b * shock"
    return f"""
WITH RECURSIVE run AS (
  SELECT market, metric, i + 21 * j AS place, {axis('a', 'i')} AS a, {axis('b', 'j')} AS b, cast(1 AS bigint) AS k,
    cast(0 AS double) AS shock, cast(0 AS double) AS total, d.w AS before
  FROM point_{turn} p JOIN diffs d USING (market, metric), range(21) x(i), range(21) y(j) WHERE d.k = 1
  UNION ALL
  SELECT market, metric, place, a, b, d.k, {shock}, total + ({shock}) * ({shock}), d.w
  FROM run JOIN diffs d USING (market, metric) WHERE d.k = run.k + 1)
SELECT * FROM (SELECT *, min(total) OVER (PARTITION BY market, metric) AS least
  FROM run JOIN (SELECT market, metric, max(k) AS k FROM diffs GROUP BY 1, 2) e USING (market, metric, k)) t
WHERE total <= least * (1 + {fc.TIE!r}) QUALIFY row_number() OVER ({_OF} place) = 1"""


def _forecast_steps(held: int, ahead: int) -> dict[str, str]:
    """Fit on all but the last ``held`` months, values of the next ``ahead``."""
    steps = {
        "series": _SERIES_SQL,
        "used": f"""SELECT * FROM (SELECT *, row_number() OVER ({_OF} month) AS t, row_number() OVER ({_OF} month DESC) AS back
  FROM series) n WHERE back > {held}""",
        "filled": f"""
SELECT *, CASE WHEN v0 IS NULL THEN v1 WHEN v1 IS NULL OR t0 = t1 THEN v0
    ELSE v0 + (v1 - v0) / (t1 - t0) * (t - t0) END AS f
FROM (SELECT *, last_value(v IGNORE NULLS) OVER past AS v0, first_value(v IGNORE NULLS) OVER later AS v1,
    last_value(place IGNORE NULLS) OVER past AS t0, first_value(place IGNORE NULLS) OVER later AS t1
  FROM (SELECT *, CASE WHEN v IS NOT NULL THEN t END AS place FROM used) u
  WINDOW past AS ({_OF} t ROWS UNBOUNDED PRECEDING), later AS ({_OF} t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) g""",
        "lags": f"""
SELECT *, lag(w, 1) OVER s AS w1, lag(w, 12) OVER s AS w12, lag(w, 13) OVER s AS w13
FROM (SELECT *, v - lag(v) OVER ({_OF} t) AS w, f - lag(f) OVER ({_OF} t) AS p FROM filled) d WINDOW s AS ({_OF} t)""",
        "gram": f"""
SELECT market, metric, sum(w * w1) AS n1, sum(w * w12) AS n12, sum(w * w13) AS n13, sum(w1 * w1) AS g1, sum(w1 * w12) AS g1_12,
  sum(w1 * w13) AS g1_13, sum(w12 * w12) AS g12, sum(w12 * w13) AS g12_13, sum(w13 * w13) AS g13
FROM lags WHERE w IS NOT NULL AND w1 IS NOT NULL AND w12 IS NOT NULL AND w13 IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= {fc.MIN_RESIDUALS}""",
        "fit": f"""
WITH RECURSIVE turns AS (
  SELECT market, metric, cast(0 AS double) AS a, cast(0 AS double) AS s, 0 AS turn, cast(1 AS double) AS moved FROM gram
  UNION ALL
  SELECT market, metric, a_next, s_next, turn + 1, abs(a_next - a) + abs(s_next - s)
  FROM (SELECT *, {_slope_sql("n12 - a_next * (g1_12 + n13) + a_next * a_next * g1_13",
                              "g12 - 2 * a_next * g12_13 + a_next * a_next * g13")} AS s_next
    FROM (SELECT *, {_slope_sql("n1 - s * (g1_12 + n13) + s * s * g12_13", "g1 - 2 * s * g1_13 + s * s * g13")} AS a_next
      FROM turns JOIN gram USING (market, metric) WHERE moved >= {fc.SETTLED} AND turn < {fc.ROUNDS}) x) y)
SELECT market, metric, floor(a * 1e6 + 0.5) / 1e6 AS a, floor(s * 1e6 + 0.5) / 1e6 AS s FROM turns WHERE moved < {fc.SETTLED}""",
        "spread": """
SELECT market, metric, avg(e * e) AS variance FROM (
  SELECT market, metric, w - a * w1 - s * w12 + a * s * w13 AS e FROM lags JOIN fit USING (market, metric)) t
WHERE e IS NOT NULL GROUP BY 1, 2""",
        "diffs": f"""
SELECT market, metric, w, row_number() OVER ({_OF} t) AS k FROM lags ANTI JOIN fit USING (market, metric) WHERE w IS NOT NULL""",
        "point_0": """SELECT market, metric, cast(0 AS double) AS a, cast(0 AS double) AS b FROM diffs
GROUP BY 1, 2 HAVING count(*) >= 3""",
        **{f"point_{turn + 1}": _grid_sql(turn) for turn in range(6)},
        "ends": """
SELECT market, metric, max(month) AS last, count(v) AS points, arg_max(f, t) AS y, list(p ORDER BY t DESC) AS p,
  pow(1e-6, 2) * coalesce(avg(w * w), 0) AS least_variance FROM lags GROUP BY 1, 2""",
        "model": """
SELECT e.*, f.a, f.s, q.a AS qa, q.b AS qb, q.shock,
  CASE WHEN points < 4 THEN 'none' WHEN f.a IS NOT NULL THEN 'seasonal' WHEN q.a IS NOT NULL THEN 'plain' ELSE 'none' END AS model,
  greatest(coalesce(variance, total / (k - 1)), least_variance) AS var
FROM ends e LEFT JOIN fit f USING (market, metric) LEFT JOIN spread USING (market, metric)
LEFT JOIN point_6 q USING (market, metric)""",
    }
    moves, replies = [], []
    for h in range(ahead):
        one = f"f{h}" if h else "p[1]"
        moves.append(f"CASE model WHEN 'seasonal' THEN a * {one} + s * p[{12 - h}] - a * s * p[{13 - h}] "
                     f"WHEN 'plain' THEN qa * {one}{'' if h else ' + qb * shock'} END AS f{h + 1}")
        replies.append(f"CASE model WHEN 'seasonal' THEN pow(a, {h}) ELSE {f'(qa + qb) * pow(qa, {h - 1})' if h else '1'} END")
    inner = "model"
    for move in moves:
        inner = f"(SELECT *, {move} FROM {inner}) m"
    rows = " UNION ALL ".join(
        f"SELECT market, metric, cast({h} AS int) AS step, cast(last + INTERVAL {h} month AS date) AS month, model, "
        f"y + {' + '.join(f'f{i + 1}' for i in range(h))} AS mean, "
        f"{FORECAST_NORMAL_QUANTILE!r} * sqrt(var * ({' + '.join(f'pow({chr(43).join(replies[:i + 1])}, 2)' for i in range(h))})) AS half "
        "FROM moved" for h in range(1, ahead + 1))
    steps["moved"] = f"SELECT * FROM {inner}"
    steps["made"] = f"SELECT *, mean - half AS lo, mean + half AS hi FROM ({rows}) r"
    return steps


@query("forecast", """
SELECT market, metric, step, strftime(month, '%Y-%m-%d') AS month, round(mean, 4) AS mean, round(lo, 4) AS lo,
  round(hi, 4) AS hi, model FROM made""", needs=("county_kpi",), **_forecast_steps(0, FORECAST_STEPS))
def forecast(spark, folder):
    return fc.forecast(county_series(spark, folder), _KEYS)


# What the length and the gaps of a series decide: its months, whether it gets
# figures, whether they are in order, and that the seasonal model has its lags.
@query("forecast_shape", """
SELECT market, metric, step, strftime(last + to_months(step::int), '%Y-%m-%d') AS month,
  known >= 4 AND (lagged >= 3 OR steps >= 3) AS has_figures, true AS in_order, true AS model_fits
FROM (SELECT market, metric, max(month) AS last, count(v) AS known, count(w) AS steps,
    count(*) FILTER (w IS NOT NULL AND w1 IS NOT NULL AND w12 IS NOT NULL AND w13 IS NOT NULL) AS lagged
  FROM (SELECT *, lag(w, 1) OVER s AS w1, lag(w, 12) OVER s AS w12, lag(w, 13) OVER s AS w13
    FROM (SELECT *, v - lag(v) OVER (PARTITION BY market, metric ORDER BY month) AS w FROM series) d
    WINDOW s AS (PARTITION BY market, metric ORDER BY month)) l GROUP BY 1, 2) t
CROSS JOIN (SELECT unnest([1, 2, 3]) AS step) n""", needs=("county_kpi",), series=_SERIES_SQL)
def forecast_shape(spark, folder):
    series = county_series(spark, folder)
    by = Window.partitionBy(*_KEYS).orderBy("month")
    steps = series.withColumn("w", F.col("value") - F.lag("value").over(by))
    lagged = steps.withColumn("full", F.col("w").isNotNull() & F.lag("w", 1).over(by).isNotNull()
                              & F.lag("w", 12).over(by).isNotNull() & F.lag("w", 13).over(by).isNotNull())
    usable = lagged.groupBy(*_KEYS).agg(F.count_if("full").alias("lagged"))
    made = fc.forecast(series, _KEYS).join(usable, _KEYS)
    has = F.col("mean").isNotNull()
    return made.select(
        *_KEYS, "step", "month", has.alias("has_figures"),
        F.coalesce((F.col("lo") <= F.col("mean")) & (F.col("mean") <= F.col("hi")), ~has).alias("in_order"),
        (((F.col("model") == "seasonal") & (F.col("lagged") >= fc.MIN_RESIDUALS)) | (F.col("model") == "plain") & has
         | (F.col("model") == "none") & ~has).alias("model_fits"))


@query("forecast_backtest", """
SELECT market, metric, round(avg(abs((v - mean) / nullif(v, 0))) * 100, 4) AS mape_pct, count(mean) AS points
FROM series JOIN made USING (market, metric, month) GROUP BY 1, 2""",
       needs=("county_kpi",), **_forecast_steps(FORECAST_HOLDOUT, FORECAST_HOLDOUT))
def forecast_backtest(spark, folder):
    return fc.backtest(county_series(spark, folder), _KEYS)


@query("forecast_alert", """
SELECT market, metric, strftime(month, '%Y-%m-%d') AS month, round(v, 4) AS actual, round(mean, 4) AS expected,
  round(lo, 4) AS lo, round(hi, 4) AS hi, round((v - mean) / nullif(mean, 0) * 100, 1) AS deviation_pct,
  coalesce(v NOT BETWEEN lo AND hi, false) AS alert, model
FROM series JOIN made USING (market, metric, month)""", needs=("county_kpi",), **_forecast_steps(1, 1))
def forecast_alert(spark, folder):
    return fc.latest_alert(county_series(spark, folder), _KEYS)


@query("forecast_error", """
SELECT round(avg(abs((a.v - a.p) / nullif(a.v, 0))) * 100, 4) AS mape_pct, count(*) AS rows
FROM (SELECT ClosePrice AS v, ListPrice AS p FROM sold) a""", needs=("sold",))
def forecast_error(spark, folder):
    rows = stages.sold(spark, folder)
    return rows.agg(fc.mape(F.col("ClosePrice"), F.col("ListPrice")).alias("mape_pct"),
                    F.count(F.lit(1)).alias("rows"))


# --- anomalies -------------------------------------------------------------

#: What tells the sales apart: a listing may be sold again.
_SALE_KEY = ["ListingKey", "CloseDate", "ListOfficeName"]


def scored_sales(spark, folder, *shown):
    """Scored sales with the columns ``shown`` beside the key, the features and the flag."""
    wanted = [*_SALE_KEY, *shown, *FOREST_FEATURES]
    # The rule flags are left behind: the rows are written twice on the way.
    rows = stages.sold_flagged(spark, folder, wanted).select(*wanted, "quality_issue_flag")
    return isolation.isolation_scores(rows, key=_SALE_KEY)


# The whole forest in SQL: the same draws, one step per level of the trees, and
# every row walked down each of them. Column x<i> is feature i with gaps filled.
_X = [f"x{i}" for i in range(len(FOREST_FEATURES))]
_DEPTH = (FOREST_BAG - 1).bit_length()


def _draw_sql(text: str, first: int, digits: int) -> str:
    return f"cast('0x' || substr(md5({text}), {first}, {digits}) AS bigint)"


def _of_feature(prefix: str, feature: str) -> str:
    return f"CASE {feature} " + " ".join(f"WHEN {i} THEN {prefix}{x}" for i, x in enumerate(_X)) + " END"


def _length_sql(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649015329) - 2.0 * ({n} - 1) / {n} END"


def _level_sql(depth: int) -> str:
    """Nodes of a level from the bags' rows that reach it."""
    lows = ", ".join(f"min({x}) AS low_{x}, max({x}) AS high_{x}" for x in _X)
    can = ", ".join(f"CASE WHEN low_{x} < high_{x} THEN {i} END" for i, x in enumerate(_X))
    name = f"'{FOREST_SEED}:' || tree || ':' || node"
    return f"""
SELECT tree, node, feature, CASE WHEN cut >= high THEN low ELSE cut END AS threshold,
  CASE WHEN feature < 0 THEN {depth * isolation.STEP} + cast(round({isolation.STEP} * ({_length_sql("n")})) AS bigint) ELSE 0 END AS length
FROM (SELECT *, low + {_draw_sql(name, 1, 13)} / {2.0 ** 52!r} * (high - low) AS cut
  FROM (SELECT *, {_of_feature("low_", "feature")} AS low, {_of_feature("high_", "feature")} AS high
    FROM (SELECT *, CASE WHEN n <= 1 OR len(can) = 0 OR {depth} >= (SELECT max(height) FROM forest_size) THEN -1
        ELSE can[1 + {_draw_sql(name, 21, 8)} % len(can)] END AS feature
      FROM (SELECT *, [c FOR c IN [{can}] IF c IS NOT NULL] AS can
        FROM (SELECT tree, node, count(*) AS n, {lows} FROM bag_{depth} GROUP BY 1, 2) a) b) c) d) e"""


def _forest_steps() -> dict[str, str]:
    filled = ", ".join(f"coalesce(cast({c} AS double), (SELECT median({c}) FROM sold_flagged)) AS x{i}"
                       for i, c in enumerate(FOREST_FEATURES))
    day = ["strftime(CloseDate, '%Y-%m-%d')" if c == "CloseDate" else c for c in _SALE_KEY]
    key = f"concat_ws(':', '{FOREST_SEED}', {', '.join(day)})"
    steps = {
        "forest_rows": f"""SELECT *, {filled}, row_number() OVER () AS number, {_draw_sql(key, 1, 13)} AS draw FROM sold_flagged""",
        "forest_size": f"""SELECT least(count(*), {FOREST_TREES * FOREST_BAG}) AS pool, least(count(*), {FOREST_BAG}) AS bag,
  cast(ceil(log2(greatest(least(count(*), {FOREST_BAG}), 2))) AS int) AS height FROM forest_rows""",
        "forest_pool": f"""SELECT {', '.join(_X)}, row_number() OVER (ORDER BY draw, {', '.join(_SALE_KEY)}) - 1 AS slot FROM forest_rows
QUALIFY slot < {FOREST_TREES * FOREST_BAG}""",
        "bag_0": f"""SELECT cast(floor(turn / bag) AS int) AS tree, 1 AS node, {', '.join(_X)}
FROM (SELECT *, unnest(generate_series(slot, {FOREST_TREES} * bag - 1, pool)) AS turn FROM forest_pool, forest_size) t""",
    }
    walk, lengths = "forest_rows r, level_0 n0", ["n0.length"]
    for d in range(_DEPTH + 1):
        steps[f"level_{d}"] = _level_sql(d)
        if d == _DEPTH:
            break
        goes = "2 * node + CASE WHEN {value} > {n}threshold THEN 1 ELSE 0 END"
        steps[f"bag_{d + 1}"] = (
            f"SELECT tree, {goes.format(value=_of_feature('', 'feature'), n='')} AS node, {', '.join(_X)} "
            f"FROM bag_{d} JOIN level_{d} USING (tree, node) WHERE feature >= 0")
        down = goes.format(value=_of_feature("r.", f"n{d}.feature"), n=f"n{d}.").replace("node", f"n{d}.node")
        walk += f" LEFT JOIN level_{d + 1} n{d + 1} ON n{d + 1}.tree = n{d}.tree AND n{d}.feature >= 0 AND n{d + 1}.node = {down}"
        lengths.append(f"coalesce(n{d + 1}.length, 0)")
    steps["forest_lengths"] = f"SELECT r.number, sum({' + '.join(lengths)}) AS total FROM {walk} GROUP BY 1"
    steps["forest_scores"] = f"""SELECT r.*, -pow(2.0, -total / {isolation.STEP} / {FOREST_TREES}
  / (SELECT {_length_sql('bag')} FROM forest_size)) AS anomaly_score
FROM forest_rows r JOIN forest_lengths USING (number)"""
    steps["forest_labels"] = f"""SELECT *, anomaly_score < (SELECT quantile_cont(anomaly_score, {FOREST_SHARE}) FROM forest_scores) AS is_anomaly
FROM forest_scores"""
    return steps


@query("isolation_scores", """
SELECT ListingKey, round(ClosePrice, 4) AS ClosePrice, round(anomaly_score, 4) AS anomaly_score, is_anomaly, quality_issue_flag
FROM forest_labels""", needs=("sold_flagged",), **_forest_steps())
def isolation_scores(spark, folder):
    return scored_sales(spark, folder).select(
        "ListingKey", "ClosePrice", "anomaly_score", "is_anomaly", "quality_issue_flag")


@query("novel_anomalies", f"""
SELECT ListingKey, City, CountyOrParish, PropertySubType, round(ClosePrice, 4) AS ClosePrice, round(LivingArea, 4) AS LivingArea,
  BedroomsTotal, BathroomsTotalInteger, round(price_per_sqft, 4) AS price_per_sqft, YearBuilt, round(anomaly_score, 4) AS anomaly_score
FROM (SELECT * FROM forest_labels WHERE is_anomaly AND quality_issue_flag = 0
  ORDER BY forest_labels.anomaly_score, ListingKey LIMIT {FOREST_EXAMPLES}) t""", needs=("sold_flagged",), **_forest_steps())
def novel_anomalies(spark, folder):
    scored = scored_sales(spark, folder, "City", "CountyOrParish", "PropertySubType")
    return isolation.most_anomalous(scored, "ListingKey").select(
        "ListingKey", "City", "CountyOrParish", "PropertySubType", "ClosePrice", "LivingArea",
        "BedroomsTotal", "BathroomsTotalInteger", "price_per_sqft", "YearBuilt", "anomaly_score")


@query("anomaly_counts", """
SELECT count(*) AS rows, count(*) FILTER (is_anomaly) AS anomalies,
  count(*) FILTER (is_anomaly AND quality_issue_flag = 0) AS novel FROM forest_labels""",
       needs=("sold_flagged",), **_forest_steps())
def anomaly_counts(spark, folder):
    return isolation.anomaly_counts(scored_sales(spark, folder))


# The label and the novelty rule do not depend on where the score comes from.
_NEG_PRICE = "SELECT *, -ClosePrice / 100000 AS anomaly_score FROM sold_flagged"


@query("anomaly_label", """
SELECT count(*) AS rows, count(*) FILTER (s < cut) AS anomalies,
  count(*) FILTER (s < cut AND quality_issue_flag = 0) AS novel
FROM (SELECT anomaly_score AS s, quality_issue_flag FROM scored) a,
  (SELECT quantile_cont(anomaly_score, 0.01) AS cut FROM scored) c""",
       needs=("sold_flagged",), scored=_NEG_PRICE)
def anomaly_label(spark, folder):
    rows = stages.sold_flagged(spark, folder).withColumn("anomaly_score", -F.col("ClosePrice") / 100000)
    return isolation.anomaly_counts(isolation.label_anomalies(rows))


# --- valuation -------------------------------------------------------------

def value_rows(spark, folder):
    """Feature rows of the clean sales with the mean rate of the month."""
    columns = [*[c for c in VALUE_NUMERIC if c != rates.RATE], *VALUE_BOOLEAN, *VALUE_CATEGORY,
               "CloseDate", "ClosePrice"]
    clean = stages.sold_clean(spark, folder, columns)
    return valuation.staged_rows(rates.enrich(clean, "CloseDate", rate_rows(spark, folder)))


@query("avm_feature_rows", """
SELECT month_index, count(*) AS rows, round(avg(label), 4) AS mean_label, count(YearBuilt) AS with_year,
  round(avg(pool), 4) AS mean_pool, round(avg(rate_30yr_fixed), 4) AS mean_rate
FROM (SELECT close_year * 12 + close_month AS month_index, ln(1 + ClosePrice) AS label, YearBuilt,
    cast(PoolPrivateYN AS int) AS pool, r.rate_30yr_fixed
  FROM sold_clean s LEFT JOIN rates_monthly r ON s.yr_mo = r.yr_mo WHERE ClosePrice > 0) t GROUP BY 1""",
       needs=("sold_clean", "rates_monthly"))
def avm_feature_rows(spark, folder):
    return value_rows(spark, folder).groupBy("month_index").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("label").alias("mean_label"),
        F.count("YearBuilt").alias("with_year"), F.avg("PoolPrivateYN").alias("mean_pool"),
        F.avg("rate_30yr_fixed").alias("mean_rate"))


_NUMBERS = len(VALUE_NUMERIC) + len(VALUE_BOOLEAN)


# A filled value and a marker per number, a column per category value.
@query("avm_feature_build", f"""
SELECT month_index, round(actual, 4) AS actual, round(label, 4) AS label, width FROM (
  SELECT close_year * 12 + close_month AS month_index, ClosePrice AS actual, ln(1 + ClosePrice) AS label
  FROM sold_clean WHERE ClosePrice > 0) t
CROSS JOIN (SELECT {2 * _NUMBERS} + {' + '.join(f'count(DISTINCT {c})' for c in VALUE_CATEGORY)} AS width
  FROM sold_clean WHERE ClosePrice > 0) w""", needs=("sold_clean",))
def avm_feature_build(spark, folder):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = value_rows(spark, folder)
    built = Pipeline(stages=valuation.feature_stages(valuation.feature_medians(rows))).fit(rows).transform(rows)
    return built.select("month_index", "actual", "label",
                        F.size(vector_to_array("features")).alias("width"))


_FEATURES = [*VALUE_NUMERIC, *VALUE_BOOLEAN, *VALUE_CATEGORY]
#: Where this application has written the model of a folder, so that it is fitted once.
_models: dict[tuple[str, str], str] = {}


def fitted(spark, folder):
    """(model, test rows). The fit is the same for all queries of an application."""
    train, test = valuation.split_by_month(value_rows(spark, folder))
    key = spark.sparkContext.applicationId, folder
    if key not in _models or not is_staged(spark, _models[key]):
        _models[key] = staged_path(spark, "value-model")
        sinks.write_model(valuation.fit_value_model(train), _models[key])
    return PipelineModel.load(_models[key]), test


@query("avm_score")
def avm_score(spark, folder):
    model, test = fitted(spark, folder)
    scored = stage(valuation.score_values(model, test).select("actual", "predicted"), "value-scores")
    return valuation.regression_metrics(scored)


@query("avm_drivers")
def avm_drivers(spark, folder):
    model, test = fitted(spark, folder)
    explained, _ = attribution.attributions(model, test, _FEATURES)
    return attribution.drivers(explained, _FEATURES, DRIVER_TOP)


# Effects add up to what the prediction is above the mean, row by row.
@query("avm_effects_add_up", """
SELECT month_index, count(*) AS rows, count(*) AS explained FROM (
  SELECT close_year * 12 + close_month AS month_index FROM sold_clean WHERE ClosePrice > 0) t
WHERE month_index >= (SELECT max(m) FROM (
  SELECT m, sum(n) OVER (ORDER BY m DESC) AS newest, sum(n) OVER () AS total
  FROM (SELECT close_year * 12 + close_month AS m, count(*) AS n FROM sold_clean WHERE ClosePrice > 0 GROUP BY 1) c) r
  WHERE newest >= 0.2 * total)
GROUP BY 1""", needs=("sold_clean",))
def avm_effects_add_up(spark, folder):
    model, test = fitted(spark, folder)
    explained, mean = attribution.attributions(model, test, _FEATURES)
    total = sum((F.col(f"effect_{c}") for c in _FEATURES), F.lit(mean))
    return explained.groupBy("month_index").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(total - F.col("prediction")) < 1e-6).alias("explained"))


@query("regression_metrics", """
SELECT count(*) AS rows, round(avg(abs(p - a)), 4) AS mae, round(sqrt(avg((p - a) * (p - a))), 4) AS rmse,
  round(1 - avg((p - a) * (p - a)) / var_pop(a), 4) AS r2,
  round(median(abs(p - a) / nullif(a, 0)) * 100, 4) AS mdape_pct,
  round(avg(CASE WHEN abs(p - a) / nullif(a, 0) <= 0.1 THEN 1 WHEN a <> 0 THEN 0 END) * 100, 4) AS ppe10_pct
FROM (SELECT ClosePrice AS a, ListPrice AS p FROM sold_clean) t""", needs=("sold_clean",))
def regression_metrics(spark, folder):
    rows = stages.sold_clean(spark, folder, ["ClosePrice", "ListPrice"])
    return valuation.regression_metrics(rows, "ClosePrice", "ListPrice")
