"""Toxicity from a fuzzy lexicon and context windows (operator 5).

* Lexicon: a short fixed list of terms of abuse, and words and word beginnings
  that labelled rows show far more often in toxic texts than in others.
* Matching: the lexicon is a trie; the Levenshtein automaton of the word being
  read runs along it. A state is the set of (trie node, edits spent); states
  are made as they are met and kept, so reading a word is one step of a
  deterministic automaton per character and most words end in the dead state
  after a few. Words within one edit of a word count as misspelled. Words that
  begin within one edit of a stem of six letters or more, and with its first
  letter, are weak evidence: they are counted apart and get a weight of their
  own, as clean texts hold such words by chance. A word that only a stem or an edit brings
  near is no hit if labelled clean texts show that it is a word of its own.
* Context: hits add up in a sliding window of words. A hit inside quotation
  marks or shortly after a word of reporting counts only a part, which keeps
  quotation apart from abuse.
* A logistic regression over the counts and the best window gives the score.

The fit uses at most about ``fit_rows`` labelled rows, drawn by a hash of the
id, one row for each id; terms need a least support there, so their number is bounded too. Scoring
is one pass over whole texts without a shuffle.

Defined cases: a null or empty text has no hits and the score of such texts;
null labels are not used; several labels of a document are averaged, 0.5
counting as 1; repeated and null ids are scored like any row; without both kinds
of labels the fixed list decides with preset weights. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import map_batches, stage, texts_of
from parcelmill.llm.quality import draw_labels, labelled_texts

#: Common English terms of abuse, known before any label is seen.
SEED_TERMS = (
    "idiot", "moron", "stupid", "scum", "loser", "trash", "clown", "pathetic", "worthless", "disgusting",
    "imbecile", "dumbass", "bastard", "asshole", "bitch", "retard", "pervert", "vermin", "coward", "filthy",
)
#: Words that report what someone else said.
REPORTING = frozenset(("said", "says", "called", "calls", "wrote", "writes", "quoted", "quotes", "quote", "term", "word",
                       "replied", "shouted", "allegedly", "according"))

WINDOW, QUOTED_PART, AFTER_REPORT, SEED_WEIGHT = 40, 0.3, 4, 4.0
STEM_SIZES = range(4, 10)
_WORD = re.compile(r"\w+")
# Quotations of any length, over line breaks too; a plain mark opens before a word and closes behind one.
_QUOTED = re.compile(r"(?<!\w)\"[^\"]+\"(?!\w)|“[^”]+”|«[^»]+»|„[^“]+“")
_MEMORY, _STATES, LEAST_STEM = 200_000, 50_000, 6
NO_HIT = (0.0, 0)


@dataclass(frozen=True)
class Lexicon:
    """``words`` match whole words, ``stems`` the beginnings of words; both map
    to a weight. ``ordinary``: words near a term, or begun by a stem, that clean
    texts use as well."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    ordinary: frozenset[str] = frozenset()


class Automaton:
    """Trie of the lexicon with Levenshtein automata of distance one.

    Words and stems shorter than ``least`` are matched exactly, by lookup: for
    them one edit leads to too many other words, and stems shorter than ``LEAST_STEM`` likewise.
    """

    def __init__(self, lexicon: Lexicon, least: int = 5) -> None:
        self.lexicon = lexicon
        self.child: list[dict[str, int]] = [{}]
        self.first = [""]  # by node: the first letter of its terms
        self.word: list[float] = [0.0]
        self.stem: list[float] = [0.0]
        self.sizes = sorted({len(x) for x in lexicon.stems})
        for term, weight in lexicon.words.items():
            if len(term) >= least:
                self.word[self._add(term)] = weight
        for term, weight in lexicon.stems.items():
            if len(term) >= LEAST_STEM:
                self.stem[self._add(term)] = weight
        self._begin()
        self.memory: dict[str, tuple[float, int]] = {}

    def _begin(self) -> None:
        """Forget all states but the first."""
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.begun: list[dict[str, float]] = []  # by state: best stem that ends there, by its first letter
        self.steps: list[dict[str, int]] = []
        self.start = self._state(frozenset(self._skips({(0, 0)})))

    def _add(self, term: str) -> int:
        node = 0
        for c in term:
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.first.append(self.first[node] or c)
                self.word.append(0.0)
                self.stem.append(0.0)
            node = self.child[node][c]
        return node

    def _skips(self, members: set) -> set:
        """A letter of the term may be missing in the word."""
        return members | {(n, 1) for node, edits in members if edits == 0 for n in self.child[node].values()}

    def _state(self, members: frozenset) -> int:
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            begun: dict[str, float] = {}
            for n, _ in members:
                if self.stem[n]:
                    begun[self.first[n]] = max(begun.get(self.first[n], 0.0), self.stem[n])
            self.begun.append(begun)
            self.steps.append({})
        return self.states[members]

    def _step(self, state: int, c: str) -> int:
        after = set()
        for node, edits in self.members[state]:
            if c in self.child[node]:
                after.add((self.child[node][c], edits))
            if edits == 0:
                after.add((node, 1))  # one letter too many
                after.update((n, 1) for n in self.child[node].values())  # another letter
        found = self._state(frozenset(self._skips(after)))
        self.steps[state][c] = found
        return found

    def match(self, word: str) -> tuple[float, int]:
        """(weight, kind) of the best term, or NO_HIT. Kind 0: as it is, 1: a
        word with one edit, 2: begins within one edit of a stem."""
        best = self.lexicon.words.get(word, 0.0)
        if not best and word in self.lexicon.ordinary:
            return NO_HIT
        for k in self.sizes:
            best = max(best, self.lexicon.stems.get(word[:k], 0.0))
        if best:
            return best, 0
        if len(self.members) > _STATES:
            self._begin()
        state, begun = self.start, 0.0
        for c in word:
            after = self.steps[state].get(c)
            state = self._step(state, c) if after is None else after
            if not self.members[state]:
                break
            if self.begun[state]:
                begun = max(begun, self.begun[state].get(word[0], 0.0))
        near = max((self.word[n] for n, _ in self.members[state]), default=0.0)
        return (near, 1) if near else (begun, 2) if begun else NO_HIT

    def hits(self, words: list[str]) -> list[tuple[int, float, int]]:
        """(place, weight, kind) of the words that match."""
        known = self.memory
        if len(known) > _MEMORY:
            known.clear()
        found = {}
        for w in set(words):
            hit = known.get(w)
            if hit is None:
                hit = known[w] = self.match(w)
            if hit is not NO_HIT:
                found[w] = hit
        return [(i, *found[w]) for i, w in enumerate(words) if w in found] if found else []


FEATURES = ("exact", "misspelled", "weight", "window", "density", "different", "alike")


def features(text: str, automaton: Automaton) -> list[float]:
    """The values of ``FEATURES`` for one text."""
    low = text.lower()
    words = _WORD.findall(low)
    found = automaton.hits(words)
    if not found:
        return [0.0] * len(FEATURES)
    hits = [x for x in found if x[2] < 2]
    part = _context(low, words, hits)
    weights = [w * p * (0.7 if kind else 1.0) for (_, w, kind), p in zip(hits, part)]
    best = now = 0.0
    first = 0
    for k, (at, _, _) in enumerate(hits):
        now += weights[k]
        while hits[first][0] <= at - WINDOW:
            now -= weights[first]
            first += 1
        best = max(best, now)
    exact = sum(p for (_, _, kind), p in zip(hits, part) if not kind)
    near = sum(p for (_, _, kind), p in zip(hits, part) if kind)
    return [math.log1p(exact), math.log1p(near), math.log1p(sum(weights)), math.log1p(best),
            math.log1p(100 * sum(part) / len(words)), math.log1p(len({words[i] for i, _, _ in hits})), math.log1p(len(found) - len(hits))]


def _context(low: str, words: list[str], hits: list[tuple[int, float, int]]) -> list[float]:
    """1 for abuse, less for a hit in quotation or after a reporting word."""
    quoted = [m.span() for m in _QUOTED.finditer(low)]
    places = {}
    if quoted:
        wanted = {i for i, _, _ in hits}
        places = {i: m.start() for i, m in enumerate(_WORD.finditer(low)) if i in wanted}
    found = []
    for i, _, _ in hits:
        inside = any(a <= places[i] < b for a, b in quoted) if quoted else False
        reported = not REPORTING.isdisjoint(words[max(0, i - AFTER_REPORT):i])
        found.append(QUOTED_PART if inside or reported else 1.0)
    return found


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    intercept: float
    weights: tuple[float, ...]


#: Used when labels cannot tell: one clear hit is near the middle, two are beyond.
PRESET = (-3.0, (1.0, 0.7, 0.4, 0.8, 0.2, 0.4, 0.0))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, fit_rows: int = 20_000,
        doc_id: str = "doc_id", text: str = "text", support: int = 5, share: float = 0.01, least_z: float = 3.5) -> ToxicityModel:
    """Learn lexicon and weights from the labelled rows that ``learn`` allows."""
    drawn = draw_labels(labels, label, learn, fit_rows, doc_id)
    # Bounded by fit_rows: written once, as four passes read it.
    rows = stage(labelled_texts(docs, drawn, doc_id, text), "toxic-fit")
    sizes = dict(rows.groupBy("target").count().collect())
    toxic, clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    seeds = {t: SEED_WEIGHT for t in SEED_TERMS}
    if not toxic or not clean:
        return ToxicityModel(Lexicon(seeds), *PRESET)
    lexicon = _learn_lexicon(rows, toxic, clean, max(support, math.ceil(share * toxic)), least_z, seeds)
    # Features are made where the rows lie; one task reads only the bounded rows of numbers.
    vectors = stage(_with_features(rows, lexicon).select("target", *FEATURES), "toxic-features")
    vectors = stage(vectors.coalesce(1).sortWithinPartitions("target", *FEATURES), "toxic-vectors")
    model = LogisticRegression(labelCol="target", featuresCol="v", regParam=0.001, maxIter=60).fit(
        vectors.select("target", array_to_vector(F.array(*FEATURES)).alias("v")))
    return ToxicityModel(lexicon, float(model.intercept), tuple(map(float, model.coefficients.toArray())))


def _terms(text: str) -> set[str]:
    """Words, marked by a final space, and their beginnings."""
    words = set(_WORD.findall(text.lower()))
    return {w + " " for w in words} | {w[:k] for w in words for k in STEM_SIZES if len(w) > k}


def _counts(rows: DataFrame, wanted: frozenset[str] | None, extract) -> DataFrame:
    """Number of texts by term, as ``term`` and ``n``."""
    types = pa.schema([("term", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                terms = extract(text)
                counted.update(terms if wanted is None else terms & wanted)
            if len(counted) > 300_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counted)), pa.array(list(counted.values()))], schema=types)
                counted = Counter()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], schema=types)

    found = map_batches(rows.select("text"), work, T.StructType(
        [T.StructField("term", T.StringType()), T.StructField("n", T.LongType())]))
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def _learn_lexicon(rows: DataFrame, toxic: int, clean: int, least: int, least_z: float, seeds: dict[str, float]) -> Lexicon:
    # Terms with that support are bounded by the sample: each needs its share of the toxic texts.
    bad = dict(_counts(rows.where("target = 1"), None, _terms).where(F.col("n") >= least).collect())
    fine = dict(_counts(rows.where("target = 0"), frozenset(bad), _terms).collect())
    good: dict[str, float] = {}
    for term, n in bad.items():
        odds, z = _odds(n, toxic, fine.get(term, 0), clean)
        if z >= least_z and odds >= 2.0:
            good[term] = odds
    words, stems = dict(seeds), {}
    for term in good:
        if term.endswith(" "):
            words[term[:-1]] = max(words.get(term[:-1], 0.0), good[term])
        else:
            stems[term] = good[term]
    # Words near a term or begun by a stem that clean texts use as well are words of their own.
    automaton = Automaton(Lexicon(words, stems))

    def unlisted(text: str) -> set[str]:
        low = _WORD.findall(text.lower())
        return {low[i] for i, _, _ in automaton.hits(low)}.difference(words)

    near = _counts(rows, None, unlisted)
    near_bad = dict(_counts(rows.where("target = 1"), None, unlisted).collect())
    ordinary = set()
    for word, n in near.collect():
        k = near_bad.get(word, 0)
        if n > k and _odds(k, toxic, n - k, clean)[0] < 2.0:
            ordinary.add(word)
    return Lexicon(words, stems, frozenset(ordinary))


def _odds(n: int, toxic: int, m: int, clean: int) -> tuple[float, float]:
    odds = math.log((n + 0.5) / (toxic + 1)) - math.log((m + 0.5) / (clean + 1))
    return odds, odds / math.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))


def _with_features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``FEATURES``."""
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(lexicon)
        for batch in batches:
            rows = np.array([features(x, automaton) for x in texts_of(batch.column(at))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c) for c in rows.T.copy())], names=[*batch.schema.names, *FEATURES])

    return map_batches(docs, work, T.StructType(
        [*docs.schema.fields, *(T.StructField(f, T.DoubleType()) for f in FEATURES)]))


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` per row, from 0 to 1; higher: toxic is likelier."""
    rows = _with_features(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), model.lexicon)
    total = F.lit(model.intercept)
    for name, weight in zip(FEATURES, model.weights):
        total = total + F.col(name) * F.lit(weight)
    return rows.select("doc_id", (1 / (1 + F.exp(-total))).alias("score"))
