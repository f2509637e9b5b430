"""Exact Shapley values of boosted trees.

The value of a set of known features is the tree's mean over the unknown ones,
weighted by the training rows that went each way (Lundberg et al., 2020). For a
leaf with value v, and for each feature j on its path the share z_j of rows that
pass its conditions and o_j, 1 or 0, whether the row explained passes them, the
Shapley value of j is

    v (o_j - z_j) * integral over t in [0, 1] of the product over i <> j of z_i (1 - t) + o_i t

as the weights k! (m - 1 - k)! / m! are Beta integrals. The integrand is a
polynomial of degree m - 1, so Gauss-Legendre points make the integral exact.
It depends on the row through the bits o_j only: each leaf has a small table
by bits. Leaves beside each other have most of their path in common, so their bits
follow from one short code, and rows look the sum of their tables up by it.

The trees travel to the tasks as a flat table of nodes whose size does not depend on
the rows; rows are explained where they lie, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.packaging import ship
from parcelmill.session import staged_path

#: Rows explained at once, bits up to which a table is made whole, and bits of a group's code.
CHUNK_ROWS, TABLE_BITS, GROUP_BITS = 50_000, 10, 9

Tests = tuple[tuple[int, bool], ...]


@dataclass(frozen=True)
class Leaf:
    """``tests``: per feature on the path, the (node, whether it went left) to pass."""

    value: float
    features: tuple[int, ...]
    shares: tuple[float, ...]
    tests: tuple[Tests, ...]


@dataclass(frozen=True)
class Group:
    """Leaves whose bits follow from one code. ``bits``: the tests that set each bit
    of the code. ``needs``: per leaf and feature on its path the bits of the code
    that decide and what they must be."""

    bits: tuple[Tests, ...]
    features: tuple[int, ...]
    leaves: tuple[Leaf, ...]
    needs: tuple[np.ndarray, ...]


def _group(leaves: list[Leaf], common: set, feature_of: dict[int, int]) -> Group:
    """``common``: the tests that are on all paths; they make one bit a feature."""
    shared: dict[int, list] = {}
    for test in sorted(common):
        shared.setdefault(feature_of[test[0]], []).append(test)
    nodes = sorted({node for leaf in leaves for tests in leaf.tests for node, left in tests if (node, left) not in common})
    bit_of = {f: i for i, f in enumerate(shared)}
    node_bit = {node: len(shared) + i for i, node in enumerate(nodes)}
    needs = []
    for leaf in leaves:
        found = []
        for f, tests in zip(leaf.features, leaf.tests):
            decide = want = 1 << bit_of[f] if f in bit_of else 0
            for node, left in tests:
                if (node, left) not in common:
                    decide |= 1 << node_bit[node]
                    want |= left << node_bit[node]
            found.append((decide, want))
        needs.append(np.array(found).reshape(-1, 2))
    return Group((*map(tuple, shared.values()), *(((node, True),) for node in nodes)),
                 tuple(sorted({f for leaf in leaves for f in leaf.features})), tuple(leaves), tuple(needs))


@dataclass(frozen=True)
class Tree:
    """``splits``: node, feature, threshold and, for a categorical feature, the values that go left."""

    splits: tuple[tuple[int, int, float, tuple[float, ...] | None], ...]
    leaves: tuple[Leaf, ...]

    def mean(self) -> float:
        return sum(x.value * float(np.prod(x.shares)) for x in self.leaves)

    @cached_property
    def groups(self) -> list[Group]:
        """The leaves in their order, as many together as a code of ``GROUP_BITS`` can tell."""
        feature_of = {f[0]: f[1] for f in self.splits}
        found: list[Group] = []
        held: list[Leaf] = []
        common: set = set()
        every: set = set()
        for leaf in self.leaves:
            if not leaf.features:
                continue
            own = {t for tests in leaf.tests for t in tests}
            both, all_tests = (common & own, every | own) if held else (own, own)
            bits = len({feature_of[n] for n, _ in both}) + len({n for n, _ in all_tests - both})
            if held and bits > min(GROUP_BITS, TABLE_BITS):
                found.append(_group(held, common, feature_of))
                held, both, all_tests = [], own, own
            held.append(leaf)
            common, every = both, all_tests
        return [*found, _group(held, common, feature_of)] if held else found


def node_table(model: PipelineModel, spark) -> DataFrame:
    """(tree, weight, node, feature, threshold, categories, left, right, value,
    cover) of the boosted trees that end ``model``; a leaf has feature -1."""
    path = staged_path(spark, "trees")
    model.stages[-1].write().save(path)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    known = split["leftCategoriesOrThreshold"]
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), split["featureIndex"].alias("feature"),
        F.when(split["numCategories"] == -1, F.get(known, F.lit(0))).alias("threshold"),
        F.when(split["numCategories"] > 0, known).alias("categories"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["prediction"].alias("value"), n["rawCount"].cast("double").alias("cover"))
    return nodes.join(weights, "tree")


def each_tree(nodes: pa.Table) -> Iterator[Tree]:
    """The trees of a ``node_table``, one at a time, with weighted leaves."""
    nodes = nodes.sort_by([("tree", "ascending"), ("node", "ascending")])
    starts = np.flatnonzero(np.diff(nodes.column("tree").to_numpy(), prepend=-1))
    for start, end in zip(starts, [*starts[1:], nodes.num_rows]):
        part = nodes.slice(start, end - start)
        weight = part.column("weight")[0].as_py()
        names = ("node", "feature", "threshold", "categories", "left", "right", "value", "cover")
        rows = {r[0]: r for r in zip(*(part.column(c).to_pylist() for c in names))}
        leaves: list[Leaf] = []
        open_nodes: list[tuple[int, dict[int, tuple[float, tuple]]]] = [(0, {})]
        while open_nodes:
            number, path = open_nodes.pop()
            _, feature, _, _, left, right, value, cover = rows[number]
            if left < 0:
                parts = sorted(path.items())
                leaves.append(Leaf(value * weight, tuple(f for f, _ in parts), tuple(p[0] for _, p in parts), tuple(p[1] for _, p in parts)))
                continue
            share, tests = path.get(feature, (1.0, ()))
            for child, goes_left in ((left, True), (right, False)):
                passed = share * (rows[child][-1] / cover if cover else 0.5)
                open_nodes.append((child, {**path, feature: (passed, (*tests, (number, goes_left)))}))
        yield Tree(tuple((k, f, 0.0 if cut is None else cut, None if kinds is None else tuple(kinds))
                         for k, f, cut, kinds, left, *_ in rows.values() if left >= 0), tuple(leaves))


def trees_of(nodes: DataFrame) -> list[Tree]:
    """All trees at once. Bounded by the number and depth of trees."""
    return list(each_tree(nodes.toArrow()))


@lru_cache(maxsize=64)
def _points(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points and weights on [0, 1] for a path of ``m`` features."""
    at, weight = np.polynomial.legendre.leggauss((m + 1) // 2)
    return (at + 1) / 2, weight / 2


def leaf_table(leaf: Leaf, bits: np.ndarray) -> np.ndarray:
    """Shapley values of the leaf's features for rows of ``bits`` (0 or 1)."""
    at, weight = _points(len(leaf.features))
    z = np.array(leaf.shares)
    factors = z[None, :, None] * (1 - at) + bits[:, :, None] * at
    # Products of all factors but one, from the left and from the right.
    before, behind = np.ones_like(factors), np.ones_like(factors)
    before[:, 1:] = np.cumprod(factors, axis=1)[:, :-1]
    behind[:, :-1] = np.cumprod(factors[:, ::-1], axis=1)[:, ::-1][:, 1:]
    return leaf.value * (bits - z) * ((before * behind) @ weight)


@lru_cache(maxsize=64)
def _all_bits(m: int) -> np.ndarray:
    return (np.arange(1 << m) >> np.arange(m)[:, None] & 1).astype(bool)


def whole_table(leaf: Leaf) -> np.ndarray:
    """``leaf_table`` of all bits, a line per feature. The product of all factors is
    doubled feature by feature, and a feature's own factor divided out again."""
    m = len(leaf.features)
    z = np.array(leaf.shares)
    if m > TABLE_BITS or not z.all():
        return leaf_table(leaf, _all_bits(m).T.astype(float)).T
    at, weight = _points(m)
    failed = z[:, None] * (1 - at)
    passed = failed + at
    product = np.empty((1 << m, len(at)))
    product[0] = leaf.value * weight
    for j in range(m):
        half = 1 << j
        np.multiply(product[:half], passed[j], out=product[half:2 * half])
        product[:half] *= failed[j]
    return np.where(_all_bits(m), ((1 - z)[:, None] / passed) @ product.T, (-z[:, None] / failed) @ product.T)


def group_table(group: Group, codes: np.ndarray) -> np.ndarray:
    """Summed Shapley values of the leaves for rows of ``codes``, a line per feature of the group."""
    found = np.zeros((len(group.features), len(codes)))
    line = {f: i for i, f in enumerate(group.features)}
    for leaf, needs in zip(group.leaves, group.needs):
        m = len(leaf.features)
        bits = (codes & needs[:, :1]) == needs[:, 1:]
        if m > TABLE_BITS:
            values = leaf_table(leaf, bits.T.astype(float)).T
        else:
            values = whole_table(leaf).take((1 << np.arange(m)) @ bits, axis=1)
        found[[line[f] for f in leaf.features]] += values
    return found


def explain(trees: Iterable[Tree], x: np.ndarray) -> np.ndarray:
    """Shapley value of each column of ``x`` for each row.

    Columns are kept in one piece each, and groups that share conditions share
    what rows pass them."""
    columns = np.ascontiguousarray(x.T)
    found = np.zeros(columns.shape)
    for tree in trees:
        goes_left = {k: columns[f] <= cut if kinds is None else columns[f] == kinds[0] if len(kinds) == 1 else np.isin(columns[f], kinds)
                     for k, f, cut, kinds in tree.splits}
        passed: dict[Tests, np.ndarray] = {((k, True),): left for k, left in goes_left.items()}
        for group in tree.groups:
            width = len(group.bits)
            code = np.zeros(len(x), np.uint16 if width <= 16 else np.int64)
            for i, tests in enumerate(group.bits):
                if tests not in passed:
                    passes = np.ones(len(x), bool)
                    for node, left in tests:
                        passes &= goes_left[node] if left else ~goes_left[node]
                    passed[tests] = passes
                code |= np.left_shift(passed[tests], i, dtype=code.dtype)
            codes = np.arange(1 << width) if width <= TABLE_BITS else np.unique(code).astype(np.int64)
            places = code.astype(np.intp) if width <= TABLE_BITS else np.searchsorted(codes, code)
            for f, values in zip(group.features, group_table(group, codes)):
                found[f] += values.take(places)
    return found.T


def column_features(scored: DataFrame, features: list[str]) -> list[str]:
    """The feature each place of the vector ``features`` was made from."""
    attrs = scored.schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    known = {f"{c}_{form}": c for c in features for form in ("filled", "missing")}
    return [known.get(names[i]) or next(c for c in features if names[i].startswith(f"{c}_hot")) for i in range(len(names))]


def attributions(model: PipelineModel, rows: DataFrame, features: list[str]) -> tuple[DataFrame, float]:
    """``rows`` with ``prediction``, and per feature its share in it as
    ``effect_<feature>``, and the mean prediction they add up from."""
    spark = rows.sparkSession
    ship(spark)
    # As a flat table the trees are small; tasks make one at a time of it.
    nodes = node_table(model, spark).toArrow()
    scored = model.transform(rows)
    places = np.array([features.index(c) for c in column_features(scored, features)])
    columns = [*rows.columns, "prediction"]
    inputs = scored.select(*columns, vector_to_array("features").alias("_vector"))
    names = [f"effect_{c}" for c in features]
    schema = T.StructType([*inputs.schema.fields[:-1], *(T.StructField(n, T.DoubleType()) for n in names)])
    shared = spark.sparkContext.broadcast(nodes)

    def told(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        for batch in table.combine_chunks().to_batches():
            vectors = batch.column(len(columns))
            x = vectors.flatten().to_numpy().reshape(batch.num_rows, -1)
            whole = explain(each_tree(shared.value), x)
            summed = np.zeros((len(whole), len(features)))
            np.add.at(summed.T, places, whole.T)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, summed.T.copy())], names=schema.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield from told(held)
                held, size = [], 0
        if held:
            yield from told(held)

    return inputs.mapInArrow(work, schema), sum(t.mean() for t in each_tree(nodes))


def drivers(explained: DataFrame, features: list[str], top: int) -> DataFrame:
    """(feature, mean_abs) of the ``top`` features with the largest mean absolute effect."""
    means = explained.agg(*[F.avg(F.abs(F.col(f"effect_{c}"))).alias(c) for c in features])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_abs")) for c in features])
    return means.select(F.inline(pairs)).where("mean_abs IS NOT NULL").orderBy(F.col("mean_abs").desc(), "feature").limit(top)
