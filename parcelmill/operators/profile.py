"""Profiles of a table: frequencies, gaps, distributions, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import DESCRIBE_POINTS, HALF_EMPTY_PERCENT, SPARSE_PERCENT
from parcelmill.functions.quantiles import GROUP_ROWS, Quantile, median, summarise
from parcelmill.session import stage


def rows_from_one(row: DataFrame, fields: Sequence[str], values: dict[str, str]) -> DataFrame:
    """Turn a one-row wide table into one row per field.

    ``values`` maps an output column to the pattern of its source column, for
    example ``{"missing": "{}_missing"}``; source columns are cast to double
    unless all of them have one type.
    """
    types = dict(row.dtypes)
    structs = []
    for field in fields:
        entries = [F.lit(field).alias("field")]
        for out, pattern in values.items():
            same = len({types[pattern.format(f)] for f in fields}) == 1
            c = F.col(f"`{pattern.format(field)}`")
            entries.append((c if same else c.cast("double")).alias(out))
        structs.append(F.struct(*entries))
    return row.select(F.inline(F.array(*structs)))


# --- frequencies -----------------------------------------------------------

def frequency(df: DataFrame, column: str) -> DataFrame:
    """(value, rows, pct) of the non-null values; pct is of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    # The counts are written once; their sum becomes a constant, so the table is read once.
    counts = stage(counts, "frequency")
    total = F.lit(counts.agg(F.sum("rows")).first()[0])
    return counts.filter(F.col("value").isNotNull()).select(
        "value", "rows", (F.try_divide(F.col("rows"), total) * 100).alias("pct")
    )


def filter_counts(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before, after and removed by a filter, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(condition).alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def dtype_tally(df: DataFrame) -> DataFrame:
    """(dtype, columns, values): how many columns have each type and how many
    non-null values they hold."""
    types = dict(df.dtypes)
    return (
        missing_profile(df)
        .select(
            F.element_at(
                F.create_map(*[F.lit(x) for pair in types.items() for x in pair]), F.col("field")
            ).alias("dtype"),
            (F.col("rows") - F.col("missing")).alias("present"),
        )
        .groupBy("dtype")
        .agg(F.count(F.lit(1)).alias("columns"), F.sum("present").alias("values"))
    )


# --- gaps ------------------------------------------------------------------

def _is_missing(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    if dict(df.dtypes)[column] in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(field, rows, missing, pct, band) per column, from one aggregate."""
    columns = [c for c in (columns or df.columns) if c in df.columns]
    row = df.agg(
        *[F.count_if(_is_missing(df, c)).alias(f"{c}_missing") for c in columns],
        F.count(F.lit(1)).alias("_rows"),
    )
    structs = [
        F.struct(F.lit(c).alias("field"), F.col("_rows").alias("rows"),
                 F.col(f"`{c}_missing`").alias("missing"))
        for c in columns
    ]
    pct = F.round(F.try_divide(F.col("missing"), F.col("rows")) * 100, 2)
    return (
        row.select(F.inline(F.array(*structs)))
        .withColumn("pct", pct)
        .withColumn(
            "band",
            F.when(F.col("pct") > SPARSE_PERCENT, "sparse")
            .when(F.col("pct") > HALF_EMPTY_PERCENT, "half_empty")
            .otherwise("kept"),
        )
    )


def missing_top(df: DataFrame, n: int) -> DataFrame:
    """The n columns with the most gaps; columns without gaps are left out."""
    gaps = missing_profile(df).filter(F.col("missing") > 0)
    return gaps.orderBy(F.col("missing").desc(), "field").limit(n)


def present_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, present) for the listed columns that exist."""
    return missing_profile(df, columns).select(
        "field", (F.col("rows") - F.col("missing")).alias("present")
    )


# --- distributions ---------------------------------------------------------

def describe(
    df: DataFrame,
    columns: Sequence[str],
    points: Sequence[float] = tuple(DESCRIBE_POINTS),
    exact: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per field: count, mean, std (n-1), min, quantiles, max."""
    columns = [c for c in columns if c in df.columns]
    measures, quantiles = [], []
    for c in columns:
        v = F.col(c).cast("double")
        measures += [
            F.count(v).alias(f"{c}|count"), F.avg(v).alias(f"{c}|mean"),
            F.stddev_samp(v).alias(f"{c}|std"), F.min(v).alias(f"{c}|min"),
            F.max(v).alias(f"{c}|max"),
        ]
        quantiles += [Quantile(c, p, f"{c}|p{round(p * 100)}") for p in points]
    row = summarise(df, (), measures, quantiles, exact, group_rows)
    names = ["count", "mean", "std", "min", *[f"p{round(p * 100)}" for p in points], "max"]
    return rows_from_one(row, columns, {n: "{}|" + n for n in names})


def centre(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, median, mean) of each column."""
    row = summarise(
        df, (), [F.avg(c).alias(f"{c}|mean") for c in columns],
        [median(c, f"{c}|median") for c in columns],
    )
    return rows_from_one(row, columns, {"median": "{}|median", "mean": "{}|mean"})


def trimmed(df: DataFrame, column: str, low: float | None = None, strict: bool = False,
            p: float = 0.99) -> DataFrame:
    """Rows up to the p quantile of all known values, and at or above ``low``
    if given (above it when ``strict``)."""
    known = df.filter(F.col(column).isNotNull())
    bounded = known
    if low is not None:
        bounded = known.filter(F.col(column) > low if strict else F.col(column) >= low)
    top = summarise(known, (), (), [Quantile(column, p, "top")]).first()["top"]
    return bounded.filter(F.col(column) <= F.lit(top))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, rows) for equal bins from minimum to maximum. The
    maximum belongs to the last bin; empty bins are listed with 0."""
    v = F.col(column).cast("double")
    known = df.filter(v.isNotNull())
    low, high = known.agg(F.min(v), F.max(v)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, rows bigint")
    if low == high:
        # One repeated value gets a range of width 1 around it.
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.floor((v - low) / (high - low) * bins)
    counts = known.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.lit(width) * F.col("bin")).alias("low"),
        (F.lit(low) + F.lit(width) * (F.col("bin") + 1)).alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(duplicate_keys, surplus_rows) of a key column."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``. Combines before the shuffle, so
    a key with very many copies does no harm."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*df.columns)
