"""The register of runnable queries and their check statements."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.plans.oracle_base import compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Medians and other quantiles keep six decimals, everything else four.
_EXACT_PREFIXES = ("median", "p1", "p5", "p2", "p7", "p9", "q1", "q3", "iqr", "lower", "upper",
                   "min", "max", "low", "high")
# Two engines may put a value that ends in 5 on either side of the tie, in the
# last bit. Both results are moved up by this amount first.
_OFF_TIES = 2e-9


def tidy(df: DataFrame) -> DataFrame:
    """Round doubles for comparison and show dates as text."""
    columns = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype == "double":
            c = F.round(c + _OFF_TIES, 6 if name.startswith(_EXACT_PREFIXES) else 4)
        elif dtype == "date":
            c = c.cast("string")
        columns.append(c.alias(name))
    return df.select(*columns)


def _off_ties(sql: str) -> str:
    """The same step in a check: round(x, 4) becomes round((x) + amount, 4)."""
    out, at = [], 0
    for found in re.finditer(r"round\(", sql):
        depth, end, comma = 1, found.end(), None
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            if sql[end] == "," and depth == 1:
                comma = end
            end += 1
        if comma is None or sql[comma + 1 : end - 1].strip() not in ("4", "6"):
            continue
        out += [sql[at : found.end()], "(", sql[found.end() : comma], f") + {_OFF_TIES!r}"]
        at = comma
    return "".join(out) + sql[at:]


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = (), **extra: str):
    """Register a query; ``sql`` is the final select of its check, over the
    steps in ``needs`` and the ``extra`` steps."""

    def register(function):
        QUERIES[name] = lambda spark, folder: tidy(function(spark, folder))
        if sql is not None:
            ORACLES[name] = compose(_off_ties(sql), *needs, **extra)
        return function

    return register
