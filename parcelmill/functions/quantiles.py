"""Grouped aggregates with exact quantiles.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.
That is the fastest way while groups are small, and it is used for all groups
up to a size. The quantiles of larger groups are found by narrowing, so that the
tables of bins grow with the number of large groups, not of all:

1. count rows per coarse value bin, a small result because the counts combine
   before the shuffle, however large the group is;
2. running bin totals tell which bins hold the wanted ranks; the rest of the
   rows are never looked at again;
3. bins that still hold too many rows are split again, from their own minimum
   to their own maximum, until each fits one task or is a single value;
4. the rows of the remaining bins are counted per value and read off in order.

Bins only need to keep the order of the values, so the result is exact: linear
interpolation between the two neighbouring ranks, as ``percentile`` does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.session import stage

# Largest group that one percentile buffer may hold.
GROUP_ROWS = 100_000
# Largest number of rows in one bin before it is split again.
BIN_ROWS = 1_000_000
# Largest bin table that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Bins per factor e of the first pass, and pieces per later split.
BINS_PER_E = 64
PIECES = 4096


@dataclass(frozen=True)
class Quantile:
    """Wanted quantile ``p`` of ``column``, named ``alias`` in the result."""

    column: str
    p: float
    alias: str


def median(column: str, alias: str) -> Quantile:
    return Quantile(column, 0.5, alias)


def summarise(
    df: DataFrame,
    keys: Sequence[str] = (),
    measures: Sequence[Column] = (),
    quantiles: Sequence[Quantile] = (),
    exact: bool = True,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per key tuple with ``measures`` and ``quantiles``.

    Rows with a null in a key are left out. With ``exact=False`` the quantiles
    are ``approx_percentile`` values from one pass and no size check is made.
    """
    keys = list(keys)
    df = _known_keys(df, keys)
    if not quantiles:
        return df.groupBy(*keys).agg(*measures)
    if not exact:
        return _one_pass(df, keys, measures, quantiles, approximate=True)
    sizes = group_sizes(df, keys)
    seen = sizes.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("_n") > group_rows).alias("large")).first()
    if not seen["large"]:
        return _one_pass(df, keys, measures, quantiles, approximate=False)
    if seen["large"] < seen["groups"]:
        # At most one key tuple per ``group_rows`` rows.
        large = F.broadcast(stage(sizes.filter(F.col("_n") > group_rows).select(*keys), "large-groups"))
        return _one_pass(df.join(large, keys, "left_anti"), keys, measures, quantiles, approximate=False).unionByName(
            _narrowed(df.join(large, keys, "left_semi"), keys, measures, quantiles))
    return _narrowed(df, keys, measures, quantiles)


def _narrowed(df, keys, measures, quantiles) -> DataFrame:
    found = narrowed_quantiles(df, keys, quantiles)
    if keys:
        base = df.groupBy(*keys).agg(*measures) if measures else df.select(*keys).distinct()
        return base.join(found, keys, "left")
    if not measures:
        return found
    # One row of numbers; as constants they keep the plan of the measures small.
    row = found.first()
    return df.agg(*measures).select(
        "*", *[F.lit(row[q.alias]).cast("double").alias(q.alias) for q in quantiles]
    )


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, _n) with the rows of each group."""
    return _known_keys(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the largest group; one small job over the key columns."""
    return group_sizes(df, keys).agg(F.max("_n")).first()[0] or 0


def _known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _one_pass(df, keys, measures, quantiles, approximate: bool) -> DataFrame:
    points: dict[str, list[float]] = {}
    for q in quantiles:
        wanted = points.setdefault(q.column, [])
        if q.p not in wanted:
            wanted.append(q.p)
    function = F.approx_percentile if approximate else F.percentile
    arrays = [
        function(_number(column), F.array(*[F.lit(p) for p in ps])).alias(f"_q_{column}")
        for column, ps in points.items()
    ]
    named = [
        F.col(f"_q_{q.column}")[points[q.column].index(q.p)].alias(q.alias) for q in quantiles
    ]
    grouped = df.groupBy(*keys).agg(*measures, *arrays)
    plain = [c for c in grouped.columns if not c.startswith("_q_")]
    return grouped.select(*plain, *named)


def narrowed_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    quantiles: Sequence[Quantile],
    bin_rows: int = BIN_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    pieces: int = PIECES,
) -> DataFrame:
    """Exact quantiles of groups of any size; see the module text."""
    keys = list(keys)
    columns = list(dict.fromkeys(q.column for q in quantiles))
    series = [*keys, "_f"]
    values = _long_values(_known_keys(df, keys), keys, columns)
    points = F.element_at(
        F.array(*[
            F.array(*[F.lit(float(q.p)) for q in quantiles if q.column == c]) for c in columns
        ]),
        F.col("_f") + 1,
    )

    # Coarse bins: their number per series is bounded by the range of doubles.
    bins = values.groupBy(*series, "_bin").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    whole = Window.partitionBy(*series)
    upto = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("_total", F.sum("_n").over(whole)).withColumn(
        "_before", F.sum("_n").over(upto) - F.col("_n")
    )
    columns_kept = [*series, "_bin", "_lo", "_hi", "_n", "_before", "_total"]
    targets, count, largest = _settle(_holding_ranks(bins, points).select(*columns_kept), keys)

    while True:
        inside = _rows_inside(values, targets, series, count <= broadcast_rows)
        if largest <= bin_rows:
            break
        piece = F.when(F.col("_lo") == F.col("_hi"), F.lit(0)).otherwise(
            F.least(
                F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * pieces),
                F.lit(pieces - 1),
            )
        )
        parent = [*series, "_bin", "_before", "_total"]
        split = (
            inside.withColumn("_piece", piece)
            .groupBy(*parent, "_piece")
            .agg(F.sum("_copies").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        )
        upto = Window.partitionBy(*parent).orderBy("_piece").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        split = split.withColumn("_start", F.sum("_n").over(upto) - F.col("_n") + F.col("_before"))
        split = split.drop("_before").withColumnRenamed("_start", "_before")
        targets, count, largest = _settle(_holding_ranks(split, points).select(*columns_kept), keys)

    parent = [*series, "_bin", "_before", "_total"]
    counted = inside.groupBy(*parent, "_v").agg(F.sum("_copies").alias("_c"))
    upto = Window.partitionBy(*parent).orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = counted.withColumn(
        "_end", F.col("_before") + F.sum("_c").over(upto)
    ).withColumn("_start", F.col("_end") - F.col("_c"))

    # One short row per wanted rank, then one row per series, then per group.
    met = F.filter(
        F.array_distinct(_ranks(points)), lambda r: (r >= F.col("_start")) & (r < F.col("_end"))
    )
    hits = ranked.select(*series, "_total", "_v", F.explode(met).alias("_rank"))
    per_series = hits.groupBy(*series).agg(
        F.max("_total").alias("_total"),
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"),
    )

    def between_ranks(p: Column) -> Column:
        place = p * (F.col("_total") - 1)
        low = F.try_element_at("_at", F.floor(place))
        high = F.try_element_at("_at", F.ceil(place))
        rest = place - F.floor(place)
        # Equal neighbours and whole ranks are read off: infinity times 0 is no number.
        return F.when((rest == 0) | (low == high), low).otherwise(low * (1 - rest) + high * rest)

    found = per_series.select(*series, F.transform(points, between_ranks).alias("_found"))
    wide = found.groupBy(*keys).agg(*[
        F.first(F.when(F.col("_f") == i, F.col("_found")), ignorenulls=True).alias(f"_q{i}")
        for i in range(len(columns))
    ])
    order = {c: [q.p for q in quantiles if q.column == c] for c in columns}
    return wide.select(*keys, *[
        F.col(f"_q{columns.index(q.column)}")[order[q.column].index(q.p)].alias(q.alias)
        for q in quantiles
    ])


def _ranks(points: Column) -> Column:
    """The two neighbouring ranks of every wanted point, counted from 0."""
    last = F.col("_total") - 1
    return F.flatten(F.transform(points, lambda p: F.array(F.floor(p * last), F.ceil(p * last))))


def _long_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, _f = column number, _v = value, _bin) without nulls."""
    pairs = [F.struct(F.lit(i).alias("_f"), _number(c).alias("_v")) for i, c in enumerate(columns)]
    long = df.select(*keys, F.inline(F.array(*pairs))).filter(F.col("_v").isNotNull())
    # Any function that never falls as the value rises may number the bins.
    return long.withColumn(
        "_bin",
        (F.signum("_v") * F.floor(F.log1p(F.abs("_v")) * BINS_PER_E)).cast("long"),
    )


def _holding_ranks(bins: DataFrame, points: Column) -> DataFrame:
    end = F.col("_before") + F.col("_n")
    return bins.filter(F.exists(_ranks(points), lambda r: (r >= F.col("_before")) & (r < end)))


def _settle(targets: DataFrame, keys: list[str]) -> tuple[DataFrame, int, int]:
    """(target bins computed once, their number, rows of the largest one that
    is not a single value).

    Without keys there are at most two bins per wanted quantile; these few rows
    become constants. With keys there may be very many, and they are staged."""
    if not keys:
        rows = targets.collect()
        sizes = [r["_n"] for r in rows if r["_lo"] < r["_hi"]]
        fixed = targets.sparkSession.createDataFrame(rows, targets.schema)
        return fixed, len(rows), max(sizes, default=0)
    staged = stage(targets, "quantile-bins")
    size = staged.agg(
        F.count(F.lit(1)).alias("bins"),
        F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_n"))).alias("rows"),
    ).first()
    return staged, size["bins"], size["rows"] or 0


def _rows_inside(values, targets, series, small: bool) -> DataFrame:
    """Rows that fall into a target bin. The bin number is part of the key, so
    the rows of a large group spread over tasks in the shuffled form too."""
    if not small:
        # Combine equal values before they are shuffled to the join.
        values = values.groupBy(*series, "_bin", "_v").agg(F.count(F.lit(1)).alias("_copies"))
        targets_side = targets
    else:
        values = values.withColumn("_copies", F.lit(1).cast("long"))
        targets_side = F.broadcast(targets)
    joined = values.join(targets_side, [*series, "_bin"])
    return joined.filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
