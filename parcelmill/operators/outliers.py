"""Interquartile fences, outlier flags and the flagged / clean pair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.constants import FENCE, QUALITY_FLAGS
from parcelmill.functions.quantiles import GROUP_ROWS, Quantile, summarise
from parcelmill.functions.scalar import flag
from parcelmill.operators.profile import rows_from_one


def fences(df: DataFrame, fields: Sequence[str], exact: bool = True,
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row with ``<field>|q1``, ``|q3``, ``|iqr``, ``|lower``, ``|upper``
    for every field; all quartiles come from one pass."""
    fields = [f for f in fields if f in df.columns]
    quartiles = [Quantile(f, p, f"{f}|{name}") for f in fields
                 for p, name in ((0.25, "q1"), (0.75, "q3"))]
    row = summarise(df, (), (), quartiles, exact, group_rows)
    row = row.withColumns({f"{f}|iqr": F.col(f"{f}|q3") - F.col(f"{f}|q1") for f in fields})
    return row.withColumns({
        **{f"{f}|lower": F.col(f"{f}|q1") - FENCE * F.col(f"{f}|iqr") for f in fields},
        **{f"{f}|upper": F.col(f"{f}|q3") + FENCE * F.col(f"{f}|iqr") for f in fields},
    })


def add_outlier_flags(df: DataFrame, fields: dict[str, str], bounds: DataFrame | None = None) -> DataFrame:
    """Flag values strictly outside their fence; ``fields`` maps field to flag.

    The fences are one row. It is read once and its values become constants of
    the plan, so later passes over the table neither join nor compute it again
    and the clean filter reaches the scan."""
    present = {f: name for f, name in fields.items() if f in df.columns}
    row = (bounds if bounds is not None else fences(df, list(present))).first()

    def end(name: str) -> Column:
        return F.lit(row[name]).cast("double")

    flagged = df.withColumns({
        name: flag((F.col(f) < end(f"{f}|lower")) | (F.col(f) > end(f"{f}|upper")))
        for f, name in present.items()
    })
    return flagged.withColumn("outlier_any_flag", _worst(list(present.values())))


def add_quality_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_issue_flag", _worst([f for f in QUALITY_FLAGS if f in df.columns]))


def _worst(flags: Sequence[str]):
    return F.greatest(*flags) if len(flags) > 1 else F.col(flags[0])


def clean_iqr(df: DataFrame) -> DataFrame:
    """Rows without an outlier flag. Rows that break a rule stay in."""
    return df.filter(F.col("outlier_any_flag") == 0)


def clean_rate(df: DataFrame) -> DataFrame:
    """(rows, issues, clean_pct); no quality column means no issues."""
    issue = F.col("quality_issue_flag") if "quality_issue_flag" in df.columns else F.lit(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(issue).alias("issues"),
        ((1 - F.avg(issue)) * 100).alias("clean_pct"),
    )


def fence_table(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """One row per field: quartiles, fence, hits with share of all rows, p1,
    p99, minimum and maximum.

    The quartiles are found once. They become constants, and the hits are
    counted against them, so ``df`` needs no flags."""
    names = list(fields)
    measures = [F.count(F.lit(1)).alias("_rows"), *[
        side(F.col(f).cast("double")).alias(f"{f}|{name}") for f in names for side, name in ((F.min, "min"), (F.max, "max"))]]
    quantiles = [Quantile(f, p, f"{f}|{label}") for f in names
                 for p, label in ((0.01, "p1"), (0.25, "q1"), (0.75, "q3"), (0.99, "p99"))]
    row = summarise(df, (), measures, quantiles)
    row = row.withColumns({f"{f}|iqr": F.col(f"{f}|q3") - F.col(f"{f}|q1") for f in names})
    row = row.withColumns({
        **{f"{f}|lower": F.col(f"{f}|q1") - FENCE * F.col(f"{f}|iqr") for f in names},
        **{f"{f}|upper": F.col(f"{f}|q3") + FENCE * F.col(f"{f}|iqr") for f in names},
    })
    found = row.first()
    hits = df.agg(*[
        F.count_if((F.col(f) < F.lit(found[f"{f}|lower"]).cast("double")) | (F.col(f) > F.lit(found[f"{f}|upper"]).cast("double")))
        .alias(f"{f}|hits") for f in names])
    whole = hits.withColumns({
        **{f"{f}|{c}": F.lit(found[f"{f}|{c}"]).cast("double") for f in names
           for c in ("q1", "q3", "iqr", "lower", "upper", "p1", "p99", "min", "max")},
        **{f"{f}|pct": F.try_divide(F.col(f"{f}|hits"), F.lit(found["_rows"])) * 100 for f in names},
    })
    columns = ["q1", "q3", "iqr", "lower", "upper", "hits", "pct", "p1", "p99", "min", "max"]
    return rows_from_one(whole, names, {c: "{}|" + c for c in columns})


def before_after(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per field: rows, median and mean of all rows and of the clean
    rows, with the change in percent. One pass: the clean values are a column
    that is null elsewhere."""
    kept = F.col("outlier_any_flag") == 0
    both = df.withColumns({f"{f}|clean": F.when(kept, F.col(f)) for f in fields})
    measures = [F.count(F.lit(1)).alias("_all"), F.count_if(kept).alias("_kept")]
    quantiles = []
    for f in fields:
        measures += [F.avg(f).alias(f"{f}|mean_before"), F.avg(f"{f}|clean").alias(f"{f}|mean_after")]
        quantiles += [
            Quantile(f, 0.5, f"{f}|median_before"), Quantile(f"{f}|clean", 0.5, f"{f}|median_after"),
        ]
    row = summarise(both, (), measures, quantiles)
    for stat in ("median", "mean"):
        row = row.withColumns({
            f"{f}|{stat}_pct": F.try_divide(
                F.col(f"{f}|{stat}_after") - F.col(f"{f}|{stat}_before"), F.col(f"{f}|{stat}_before")
            ) * 100
            for f in fields
        })
    row = row.withColumns({
        **{f"{f}|rows_before": F.col("_all") for f in fields},
        **{f"{f}|rows_after": F.col("_kept") for f in fields},
    })
    columns = ["rows_before", "rows_after", "median_before", "median_after", "median_pct",
               "mean_before", "mean_after", "mean_pct"]
    return rows_from_one(row, list(fields), {c: "{}|" + c for c in columns})


def top_outliers(df: DataFrame, field: str, flag_name: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The n flagged rows with the largest value; ties follow the shown columns."""
    shown = [c for c in columns if c in df.columns]
    rows = df.filter(F.col(flag_name) == 1)
    return rows.orderBy(F.col(field).desc(), *shown).limit(n).select(*shown)
