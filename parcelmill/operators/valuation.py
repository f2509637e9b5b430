"""Home value model: features, boosted trees, error measures, drivers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import (
    DRIVER_TOP, LEAKAGE, VALUE_BOOLEAN, VALUE_CATEGORY, VALUE_NUMERIC,
    VALUE_TARGET, VALUE_TEST_SHARE, VALUE_TREES,
)
from parcelmill.functions.quantiles import median, summarise
from parcelmill.functions.sampling import numbered_rows, random_rows
from parcelmill.functions.scalar import one_zero
from parcelmill.operators.boosting import GBTRegressor
from parcelmill.operators.calendar import recent_months
from parcelmill.session import shared_folder, stage


def check_leakage(columns: Sequence[str]) -> None:
    leaking = sorted(LEAKAGE.intersection(columns))
    if leaking:
        raise ValueError(f"these columns give the answer away: {', '.join(leaking)}")


def feature_rows(df: DataFrame, numeric: Sequence[str] = tuple(VALUE_NUMERIC),
                 boolean: Sequence[str] = tuple(VALUE_BOOLEAN),
                 category: Sequence[str] = tuple(VALUE_CATEGORY)) -> DataFrame:
    """Rows with a positive price: features as numbers and text, the price, its
    log1p as ``label`` and ``month_index`` for the split."""
    check_leakage([*numeric, *boolean, *category])
    return df.filter(F.col(VALUE_TARGET) > 0).select(
        *[F.col(c).cast("double").alias(c) for c in numeric],
        *[one_zero(c).cast("double").alias(c) for c in boolean],
        *category,
        F.col(VALUE_TARGET).cast("double").alias("actual"),
        F.log1p(VALUE_TARGET).alias("label"),
        (F.col("close_year") * 12 + F.col("close_month")).alias("month_index"),
    )


def feature_medians(rows: DataFrame, numbers: Sequence[str] = (*VALUE_NUMERIC, *VALUE_BOOLEAN)) -> dict[str, float]:
    """Exact medians of the numbers, one value each; 0 where all are missing."""
    row = summarise(rows, (), (), [median(c, c) for c in numbers]).first()
    return {c: 0.0 if row is None or row[c] is None else float(row[c]) for c in numbers}


def feature_stages(medians: dict[str, float], numeric: Sequence[str] = tuple(VALUE_NUMERIC),
                   boolean: Sequence[str] = tuple(VALUE_BOOLEAN),
                   category: Sequence[str] = tuple(VALUE_CATEGORY)) -> list:
    """Numbers filled with ``medians``, which become constants of the model,
    with a marker for what was missing, and one column per category value; a
    missing category is all zeros."""
    numbers = [*numeric, *boolean]
    filled = ", ".join(
        f"cast({c} IS NULL AS double) AS {c}_missing, coalesce({c}, {medians[c]!r}D) AS {c}_filled" for c in numbers)
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        StringIndexer(inputCols=list(category), outputCols=[f"{c}_index" for c in category],
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in category],
                      outputCols=[f"{c}_hot" for c in category]),
        VectorAssembler(
            inputCols=[f"{c}_filled" for c in numbers] + [f"{c}_missing" for c in numbers]
            + [f"{c}_hot" for c in category],
            outputCol="features",
        ),
    ]


def split_by_month(rows: DataFrame, share: float = VALUE_TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """(train, test): the newest whole months that hold ``share`` of the rows
    are the test part."""
    first = _first_test_month(rows, share)
    return rows.filter(F.col("month_index") < first), rows.filter(F.col("month_index") >= first)


def _first_test_month(rows: DataFrame, share: float):
    numbered = rows.withColumns({
        "_y": F.floor((F.col("month_index") - 1) / 12), "_m": (F.col("month_index") - 1) % 12 + 1,
    })
    return recent_months(numbered, "_y", "_m", share).filter("is_test").agg(F.min("month_index")).scalar()


def fit_value_model(train: DataFrame, **trees) -> PipelineModel:
    """Boosted trees on log price. Settings default to the full size; pass for
    example ``maxIter=10, maxDepth=4`` for a small model."""
    shared_folder(train.sparkSession)  # the trees are checkpointed while they grow
    settings = {**VALUE_TREES, "checkpointInterval": 10, **trees}
    features = Pipeline(stages=feature_stages(feature_medians(train))).fit(train)
    grown = GBTRegressor(featuresCol="features", labelCol="label", **settings).fit(
        vector_rows(features.transform(train)))
    return PipelineModel([*features.stages, grown])


def vector_rows(built: DataFrame) -> DataFrame:
    """The vectors and labels, staged in even pieces, at least one a core.

    Each level of each tree is a job that ships the lineage of its rows to every
    task and ends with the slowest one, so the plan that makes the vectors must
    not be part of it and no piece may be much larger than the others."""
    rows = built.select("features", "label")
    pieces = max(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)
    return stage(rows.repartition(pieces), "value-vectors")


def score_values(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``predicted`` in price units."""
    return model.transform(rows).select(*rows.columns, F.expm1("prediction").alias("predicted"))


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row: mae, rmse, r2, mdape_pct, ppe10_pct and rows, of any table with
    actual and predicted values."""
    a, p = F.col(actual), F.col(predicted)
    rows = df.select(a.cast("double").alias("a"), p.cast("double").alias("p")).withColumns({
        "err": F.col("p") - F.col("a"), "ape": F.try_divide(F.abs(F.col("p") - F.col("a")), F.col("a")),
    })
    row = summarise(
        rows, (),
        [
            F.count(F.lit(1)).alias("rows"), F.avg(F.abs("err")).alias("mae"),
            F.sqrt(F.avg(F.col("err") * F.col("err"))).alias("rmse"),
            F.avg(F.col("err") * F.col("err")).alias("_mse"), F.var_pop("a").alias("_var"),
            (F.avg((F.col("ape") <= 0.10).cast("int")) * 100).alias("ppe10_pct"),
        ],
        [median("ape", "_mdape")],
    )
    return row.select(
        "rows", "mae", "rmse", (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"),
        (F.col("_mdape") * 100).alias("mdape_pct"), "ppe10_pct",
    )


def sampled_shapley(model: PipelineModel, test: DataFrame, features: Sequence[str],
                    sample: int | None = None, draws: int = 20, seed: int = 0,
                    top: int = DRIVER_TOP) -> DataFrame:
    """(feature, mean_abs): mean absolute contribution of each feature over all
    rows, or over ``sample`` of them, by sampled orders (Strumbelj and
    Kononenko, 2014).

    A draw orders the features at random and takes another row as background.
    The contribution of a feature is the change of the prediction when its own
    value is used, with the features before it in the order already own and the
    others from the background. A draw is one walk through its order, so it
    needs one prediction more than there are features."""
    if sample is None:
        rows = numbered_rows(test.select(*features), seed, "shapley-rows")
    else:
        rows = random_rows(test.select(*features), sample, seed, "shapley-rows")
    size = rows.count()
    own = rows.select("_row", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("_try"),
                      F.struct(*features).alias("own"))
    own = own.withColumn("_other", F.pmod(F.xxhash64("_row", "_try", F.lit(seed)), F.lit(size)))
    other = rows.select(F.col("_row").alias("_other"), F.struct(*features).alias("other"))
    parts = [F.struct(F.xxhash64("_row", "_try", F.lit(c), F.lit(seed + 1)).alias("key"), F.lit(c).alias("feature"))
             for c in features]
    order = F.transform(F.array_sort(F.array(*parts)), lambda x: x["feature"])
    walks = own.join(other, "_other").withColumn("order", order)
    points = walks.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(features)))).alias("_own"))
    mixed = points.select("_row", "order", "_own", *[
        F.when(F.array_position("order", c) <= F.col("_own"), F.col(f"own.{c}")).otherwise(F.col(f"other.{c}")).alias(c)
        for c in features
    ])
    # A point ends the step of the feature it adds and begins the next one's.
    ends = F.struct(F.get("order", F.col("_own") - 1).alias("feature"), F.col("prediction").alias("signed"))
    begins = F.struct(F.get("order", F.col("_own")).alias("feature"), (-F.col("prediction")).alias("signed"))
    steps = model.transform(mixed).select("_row", F.inline(F.array(ends, begins))).filter("feature IS NOT NULL")
    effect = steps.groupBy("_row", "feature").agg((F.sum("signed") / draws).alias("effect"))
    ranked = effect.groupBy("feature").agg(F.avg(F.abs("effect")).alias("mean_abs"))
    return ranked.orderBy(F.col("mean_abs").desc(), "feature").limit(top)


def staged_rows(df: DataFrame) -> DataFrame:
    """Feature rows written once: fitting reads them many times."""
    return stage(feature_rows(df), "value-rows")
