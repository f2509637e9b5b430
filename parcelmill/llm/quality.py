"""Quality classifier as a sparse rule ensemble (operator 1).

1. Statistics of a text: shares of kinds of characters, words and lines.
2. Shallow trees are grown on labelled rows; each path from a root is a rule, a
   conjunction of bounds on statistics.
3. A lasso logistic regression over all rules leaves few with a weight.
4. These rules and weights become one Spark column expression over the
   statistics, which scores every row.

The fit uses at most about ``fit_rows`` labelled rows, drawn by a hash of the
id, so the draw does not depend on the layout; this is the only sample. Their
ids and labels are broadcast, as their number is bounded. Scoring is one pass
over whole texts without a shuffle.

Defined cases: a null or empty text has the statistics of an empty text and a
score; null labels are not used; a document with several labels takes their
mean, 0.5 counting as 1; a repeated or null id is scored like any other row; no
usable label, or only one kind, gives a constant score (the share of label 1,
0.5 without labels). Statistics have names of their own inside a struct, so
columns of the input cannot clash with them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import bytes_of, map_batches, stage

STATISTICS = (
    "chars", "words", "word_length", "upper", "letters", "digits", "symbols", "bangs", "bars", "beyond_ascii",
    "spaces", "distinct_words", "commonest_word", "marked_words", "doubled_ends", "short_words", "capital_words",
    "shouted_words", "lines", "line_words", "repeated_lines", "ended_lines", "stops",
)

_FLAGS = np.zeros((256, 8))
for _b in range(256):
    _c = chr(_b)
    _FLAGS[_b] = [
        65 <= _b <= 90, 97 <= _b <= 122 or 65 <= _b <= 90 or _b >= 128, 48 <= _b <= 57,
        _b < 128 and not _c.isalnum() and not _c.isspace() and _c not in ".,;:'\"()-?", _c == "!", _c == "|",
        _b >= 128, _b < 128 and _c.isspace(),
    ]
_ENDS = tuple(b".!?:")


def statistics(data: bytes) -> list[float]:
    """The values of ``STATISTICS`` for one text in UTF-8."""
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    upper, letters, digits, symbols, bangs, bars, beyond, spaces = np.bincount(
        np.frombuffer(data, np.uint8), minlength=256) @ _FLAGS
    words = data.split()
    k = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(len(lines), 1)
    solid = max(n - spaces, 1)
    tails = [w[-2:] for w in words]
    marked = sum(not (w[-1:].isalnum() or w[-1] >= 128 or w[-1] in b".,;:?") for w in words)
    doubled = sum(len(t) == 2 and t[0] == t[1] and not t.isalnum() and t[0] < 128 for t in tails)
    return [
        math.log1p(n), math.log1p(len(words)), solid / k, upper / max(letters, 1), letters / solid, digits / solid,
        symbols / solid, bangs / k, bars / k, beyond / solid, spaces / n, len(seen) / k,
        max(seen.values(), default=0) / k, marked / k, doubled / k, sum(len(w) <= 3 for w in words) / k,
        sum(w[:1].isupper() for w in words) / k, sum(len(w) > 1 and w.isupper() for w in words) / k,
        math.log1p(len(lines)), k / m, 1 - len(set(lines)) / m, sum(x.rstrip()[-1] in _ENDS for x in lines) / m,
        data.count(b".") / k,
    ]


def with_statistics(docs: DataFrame, text: str = "text", name: str = "stats_") -> DataFrame:
    """``docs`` with a struct column of all statistics."""
    while name in docs.columns:
        name += "_"
    schema = T.StructType([
        *docs.schema.fields, T.StructField(name, T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))])
    at = docs.columns.index(text)
    kind = [pa.field(s, pa.float64()) for s in STATISTICS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(x) for x in bytes_of(batch.column(at))]).reshape(-1, len(STATISTICS))
            column = pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], fields=kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return map_batches(docs, work, schema)


@dataclass(frozen=True)
class Rule:
    """Bounds on statistics: (number of the statistic, more than, at most)."""

    bounds: tuple[tuple[int, float, float], ...]
    weight: float = 0.0

    def column(self, stats: str) -> Column:
        found = F.lit(True)
        for k, low, high in self.bounds:
            value = F.col(f"{stats}.{STATISTICS[k]}")
            if low > -math.inf:
                found = found & (value > low)
            if high < math.inf:
                found = found & (value <= high)
        return found.cast("double")


@dataclass(frozen=True)
class RuleModel:
    """score = logistic(intercept + sum of the weights of rules that hold)."""

    intercept: float
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    def column(self, stats: str) -> Column:
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + rule.column(stats) * F.lit(rule.weight)
        return 1 / (1 + F.exp(-total))


def draw_labels(labels: DataFrame, label: str, learn: Column | None, fit_rows: int, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``target`` (0 or 1) of about ``fit_rows`` labelled rows at
    most, those with the smallest hash of the id."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    if learn is not None:
        rows = rows.where(learn)
    rows = rows.groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(label) >= 0.5).cast("double").alias("target"))
    share = min(1.0, fit_rows / max(rows.count(), 1))
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return rows


def labelled_texts(docs: DataFrame, drawn: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``target`` and ``text`` of the drawn ids, one row each: of the rows that
    repeat an id the one with the least text, combined before the shuffle, so
    the bound on labels bounds the rows too."""
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    rows = rows.groupBy("doc_id", "target").agg(F.min("text").alias("text"))
    # Bounded rows, but costly to look at: dealt over all cores, where adaptive execution would join them.
    return rows.repartition(docs.sparkSession.sparkContext.defaultParallelism, "doc_id").select("target", "text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, fit_rows: int = 20_000,
        doc_id: str = "doc_id", text: str = "text", trees: int = 24, depth: int = 3, penalty: float = 0.001) -> RuleModel:
    """Learn the rules from the labelled rows that ``learn``, a condition on
    ``labels``, allows."""
    drawn = draw_labels(labels, label, learn, fit_rows, doc_id)
    rows = labelled_texts(docs, drawn, doc_id, text)
    # The scan, the join and the statistics run in many tasks; only their bounded result is read by one.
    rows = stage(with_statistics(rows.select("text", "target"), "text").select("target", "stats_.*"), "quality-stats")
    vector = array_to_vector(F.array(*STATISTICS)).alias("features")
    # A bounded number of rows: one sorted piece makes bags and sums repeatable.
    rows = stage(rows.coalesce(1).sortWithinPartitions(*STATISTICS, "target").select("target", *STATISTICS), "quality-fit")
    share = rows.agg(F.avg("target"), F.count("*")).first()
    if share[1] == 0 or share[0] in (0.0, 1.0):
        p = 0.5 if share[1] == 0 else min(max(share[0], 0.001), 0.999)
        return RuleModel(math.log(p / (1 - p)))
    forest = RandomForestClassifier(
        labelCol="target", featuresCol="features", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", subsamplingRate=0.7, minInstancesPerNode=5, seed=7,
    ).fit(rows.select("target", vector))
    rules = extract_rules(forest)
    if not rules:  # no statistic tells the labels apart
        return RuleModel(math.log(share[0] / (1 - share[0])))
    held = F.struct(*STATISTICS).alias("stats_")
    held_rules = array_to_vector(F.array(*[r.column("stats_") for r in rules])).alias("features")
    lasso = LogisticRegression(
        labelCol="target", featuresCol="features", elasticNetParam=1.0, regParam=penalty, maxIter=80, standardization=False,
    ).fit(rows.select("target", held).select("target", held_rules))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple(
        Rule(r.bounds, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9))


def extract_rules(forest) -> list[Rule]:
    """Every path from a root to a node below it, each once."""
    found: dict[tuple, Rule] = {}

    def walk(node, bounds: dict[int, tuple[float, float]]) -> None:
        if bounds:
            key = tuple((k, *bounds[k]) for k in sorted(bounds))
            found.setdefault(key, Rule(key))
        if node.subtreeDepth() == 0:
            return
        k, cut = node.split().featureIndex(), float(node.split().threshold())
        low, high = bounds.get(k, (-math.inf, math.inf))
        walk(node.leftChild(), {**bounds, k: (low, min(high, cut))})
        walk(node.rightChild(), {**bounds, k: (max(low, cut), high)})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found.values())


def score(docs: DataFrame, model: RuleModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` from 0 to 1; higher: label 1 is likelier."""
    if name in docs.columns:
        raise ValueError(f"the input already has a column {name!r}")
    held = with_statistics(docs, text)
    stats = held.columns[-1]
    return held.withColumn(name, model.column(stats)).drop(stats)
