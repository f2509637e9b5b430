"""Benchmark decontamination by rare seeds and alignment (operator 2).

1. The items' trigrams are taken in two shapes: three words in a row, and two in
   a row with the next but one, which also survives where every third word was
   edited. All documents are read once to count in how many of them each trigram
   occurs by chance, that is without another trigram of the same item near it.
   Copies of an item, however many, do not count: they would make the trigrams
   that survive in them look common.
2. Trigrams in at most ``RARE`` of all documents, or as rare as the rarer half of
   their item's, are its rare seeds.
3. Documents meet items through the trigrams. A passage that holds a rare seed, or
   two trigrams close together, is aligned with the whole item by Smith-Waterman
   over words, so edited, cut and reordered copies score as well as exact ones.
   Only a passage with fewer words of the item than the score needs is left out
   before: no alignment could reach the limit. A document is contaminated if the
   score, divided by the number of words of the item, reaches ``least``.

The items are the small side of this join. Spark deals them into parts of about
``PART`` words; one part at a time is on the driver and is sent to the tasks, so
what is broadcast is bounded; a larger benchmark takes more passes over the
documents. Documents are never shuffled.

Words are runs of letters, digits and underscores in small letters, so case,
punctuation and white space do not matter. Defined cases: a null or empty text
matches nothing; an item without words is ignored; an item of one or two words
is a seed as a whole and must occur exactly; items repeated or with a null id
are matched each; repeated documents are judged each; an empty table on either
side gives no matches; other columns are kept by ``clean`` and ignored by
``matches``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import map_batches, stage, texts_of

GRAM, PART = 3, 1_000_000
#: Places of the words of a trigram, by shape; the first two are the same.
SHAPES = ((0, 1, 2), (0, 1, 3))
#: Share of all documents in which a rare trigram may occur by chance.
RARE = 1e-3
#: Alignment: a word that agrees, one that differs or is missing on a side.
AGREE, DIFFER = 1.0, -0.5
LEAST = 0.35
_WORD = re.compile(r"\w+")


@dataclass
class Items:
    """Test items as numbers of words, and their trigrams as sorted keys."""

    ids: list
    words: list[np.ndarray]
    sets: list[frozenset[int]]  # the words of each item
    names: dict[str, int]
    grams: np.ndarray  # sorted distinct keys
    owners: list[list[tuple[int, int]]]  # per key: (item, place)
    rare: list[set[int]]  # per key: the items that have it as a rare seed
    short: list[int]  # items of fewer words than a trigram

    def keys(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each shape the places of a text where all its words are in items,
        and their keys."""
        base, n = len(self.names) + 1, len(words)
        known = words >= 0
        # Both shapes begin with two words in a row.
        two = np.flatnonzero(known[:-1] & known[1:])
        begun = words[two] * base + words[two + 1] if len(two) else two
        for shape, (_, _, last) in enumerate(SHAPES):
            some = two + last < n
            places, key = two[some], begun[some]
            third = words[places + last]
            some = third >= 0
            yield places[some], (key[some] * base + third[some]) * len(SHAPES) + shape

    def found(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(place, trigram) of the trigrams of a text that the items have."""
        hits: list[tuple[int, int]] = []
        for places, keys in self.keys(words):
            if not len(self.grams) or not len(keys):
                continue
            where = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
            same = self.grams[where] == keys
            hits += zip(places[same].tolist(), where[same].tolist())
        return hits

    def numbers(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        return np.fromiter(map(self.names.get, words, repeat(-1)), np.int64, len(words))


def read_items(rows: list[tuple]) -> Items:
    """``rows`` are (id, text)."""
    names: dict[str, int] = {}
    ids, words = [], []
    for item, text in rows:
        found = _WORD.findall((text or "").lower())
        if found:
            ids.append(item)
            words.append(np.array([names.setdefault(w, len(names)) for w in found], np.int64))
    items = Items(ids, words, [frozenset(w.tolist()) for w in words], names, np.zeros(0, np.int64), [], [],
                  [k for k, w in enumerate(words) if len(w) < GRAM])
    owners: dict[int, list[tuple[int, int]]] = {}
    for k, w in enumerate(words):
        for places, keys in items.keys(w):
            for at, key in zip(places.tolist(), keys.tolist()):
                owners.setdefault(key, []).append((k, at))
    items.grams = np.array(sorted(owners), np.int64)
    items.owners = [owners[k] for k in items.grams.tolist()]
    items.rare = [set() for _ in items.owners]
    return items


def choose_seeds(items: Items, counts: np.ndarray, documents: int) -> None:
    """Mark the rare seeds of each item: its rarer half with all ties, and all that
    occur in at most ``RARE`` of the documents."""
    of_item: list[list[tuple[int, int]]] = [[] for _ in items.ids]
    for g, owners in enumerate(items.owners):
        for k, _ in owners:
            of_item[k].append((int(counts[g]), g))
    for k, grams in enumerate(of_item):
        grams.sort()
        most = max(grams[(len(grams) - 1) // 2][0], RARE * documents) if grams else 0
        for n, g in grams:
            if n <= most:
                items.rare[g].add(k)


def align(text: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Best local score and the places of its last words in ``text`` and ``item``."""
    place = np.arange(1, len(item) + 1) * -DIFFER
    before = np.zeros(len(item) + 1)
    best, at, ends = 0.0, -1, -1
    for i, word in enumerate(text):
        now = np.maximum(before[:-1] + np.where(item == word, AGREE, DIFFER), before[1:] + DIFFER)
        now = np.maximum(now, 0)
        now = np.maximum.accumulate(now + place) - place  # words of the item left out
        top = int(now.argmax())
        if now[top] > best + 1e-9:
            best, at, ends = float(now[top]), i, top
        before[1:] = now
    return best, at, ends


def match(text: str, items: Items, least: float = LEAST) -> list[tuple]:
    """(item number, score, first and last place among the words) of each item
    found in a text, its best passage."""
    words = items.numbers(text)
    hits: dict[int, list[tuple[int, bool]]] = {}
    for p, g in items.found(words):
        for k, at in items.owners[g]:
            hits.setdefault(k, []).append((p - at, k in items.rare[g]))
    found = []
    for k, starts in sorted(hits.items()):
        item = items.words[k]
        slack = _slack(item)
        starts.sort()
        best = None
        for group in _close(starts, slack):
            if len(group) < 2 and not group[0][1]:
                continue
            low = max(0, group[0][0] - slack)
            part = words[low:group[-1][0] + len(item) + slack]
            if _most(part.tolist(), item.tolist(), items.sets[k]) * AGREE < least * len(item) - 1e-9:
                continue  # even if all of them agreed in order
            score, last, ends = align(part, item)
            if score >= least * len(item) - 1e-9 and (best is None or score > best[1]):
                _, first, _ = align(part[last::-1], item[ends::-1])
                best = (k, score, low + last - first, low + last)
        if best:
            found.append(best)
    for k in items.short:
        item = items.words[k]
        for p in range(len(words) - len(item) + 1):
            if np.array_equal(words[p:p + len(item)], item):
                found.append((k, float(len(item)), p, p + len(item) - 1))
                break
    return found


def _most(part: list[int], item: list[int], of_item: frozenset[int]) -> int:
    """No alignment of the two has more words that agree."""
    return min(sum(map(of_item.__contains__, part)), sum(map(set(part).__contains__, item)))


def _slack(item: np.ndarray) -> int:
    """How far a copy may shift a seed against the others."""
    return len(item) // 2 + 4


def by_chance(text: str, items: Items) -> set[int]:
    """Trigrams that a text holds without another one of the same item near."""
    places: dict[int, list[tuple[int, int]]] = {}
    for p, g in items.found(items.numbers(text)):
        for k, at in items.owners[g]:
            places.setdefault(k, []).append((p - at, g))
    alone = set()
    for k, hits in places.items():
        hits.sort()
        slack = _slack(items.words[k])
        for i, (start, g) in enumerate(hits):
            if (i == 0 or start - hits[i - 1][0] > slack) and (i + 1 == len(hits) or hits[i + 1][0] - start > slack):
                alone.add(g)
    return alone


def _close(hits: list[tuple[int, bool]], slack: int) -> Iterator[list[tuple[int, bool]]]:
    """Runs of sorted (place, rare) whose neighbours are at most ``slack`` apart."""
    run = [hits[0]]
    for hit in hits[1:]:
        if hit[0] - run[-1][0] > slack:
            yield run
            run = []
        run.append(hit)
    yield run


def prepare_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> Iterator[Items]:
    """Items with seeds, one part of about ``PART`` words after the other. Counts
    cover all of ``docs``."""
    rows = benchmark.select(benchmark[item_id].cast("string").alias("item"), benchmark[item_text].alias("text"))
    rows = rows.where(F.length("text") > 0).withColumn("n", F.size(F.split("text", r"(?U)\W+")))
    rows = stage(rows.withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "items")
    parts = int(rows.agg(F.sum("n")).first()[0] or 0) // PART + 1
    documents = docs.count()
    for part in range(parts):
        mine = rows.where(F.pmod("deal", F.lit(parts)) == part).select("item", "text").collect()
        items = read_items(sorted(map(tuple, mine), key=lambda r: (r[0] is None, r[0] or "", r[1])))
        if items.ids:
            choose_seeds(items, _document_counts(docs.select(text), items), documents)
            yield items


def _document_counts(texts: DataFrame, items: Items) -> np.ndarray:
    """In how many texts each trigram of the items occurs by chance."""
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known.grams), np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                counts[np.fromiter(by_chance(text, known), np.int64)] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["gram", "n"])

    rows = map_batches(texts, work, T.StructType([T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())]))
    counts = np.zeros(len(items.grams), np.int64)
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():  # a row per trigram of this part at most
        counts[gram] = n
    return counts


_MATCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("first_char", T.LongType()), T.StructField("end_char", T.LongType()),
])


def matches(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document and item that it contains: ``doc_id``, ``item_id``
    (as text), ``score`` (0 to 1) and the passage ``first_char`` to ``end_char``
    (exclusive) in code points."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    found = None
    for items in prepare_items(docs, benchmark, text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                out = []
                for doc, value in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                    hits = match(value, known, least)
                    if hits:
                        spans = [m.span() for m in _WORD.finditer(value.lower())]
                        out += [(doc, known.ids[k], score / len(known.words[k]), spans[a][0], spans[b][1]) for k, score, a, b in hits]
                columns = zip(*out) if out else [()] * 5
                types = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=_MATCH.names)

        part = map_batches(rows, work, _MATCH)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], _MATCH)


def clean(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, text: str = "text") -> DataFrame:
    """``docs`` without the documents that contain an item."""
    at = docs.columns.index(text)
    for items in prepare_items(docs, benchmark, text):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fine = [not match(value, shared.value, least) for value in texts_of(batch.column(at))]
                yield batch.filter(pa.array(fine, pa.bool_()))

        docs = map_batches(docs, work, docs.schema)
    return docs
