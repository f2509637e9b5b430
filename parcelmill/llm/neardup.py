"""Near-duplicates by MinHash bands and odd sketches (operator 6).

Words of a text, A-Z in small letters, make a set of 5-word shingles. Documents
with equal sets form a class, and only one node per class goes on.

1. Each node gets MinHash samples of its set. Groups of four are its bands; all
   samples together are folded into an odd sketch, a bitmap of which each sample
   flips one bit. The number of ones in the XOR of two sketches tells how many
   samples differ, and so estimates high similarities precisely.
2. Star round: every node is paired with one node drawn from each of its
   buckets. The closest few by sketch are confirmed on full sets. Components of
   these links hold almost every near-duplicate.
3. Rest round: in buckets that still hold several components, nodes outside the
   largest component are compared with all nodes of other components. Sketches
   decide in blocks which pairs may reach the similarity, full sets confirm
   them, and only links that join two components leave a task. A pair is looked
   at in its first common bucket only.

So no pairs inside a component are ever made, and a bucket of any size is cut
into blocks. Links are confirmed on full sets; what can be missed is a pair
without a common bucket: at a similarity of 0.75 exactly one in 4 million
(40 bands of 4), or whose sketch is off by five standard deviations.

Defined cases: a null or empty text has no shingles and is linked with nothing;
fewer than five words make one shingle; repeated rows are members of one class;
a document with a null id is grouped like any other but never names a
component, and a component of null ids alone has a null name; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import bytes_of, map_batches, stage
from parcelmill.llm.components import components

WORDS, SAMPLES, BANDS, ROWS, BITS = 5, 256, 40, 4, 1024
#: Similarity in percent from which two documents are linked.
LEAST = 75
#: Closest candidates confirmed in the star round; rows of a block in the rest round.
CLOSEST, BLOCK = 3, 1024
#: Hashes of words that a task keeps from batch to batch.
KNOWN_WORDS = 100_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.random.default_rng(20).integers(0, 2**32, (2, SAMPLES), dtype=np.uint64).astype(np.uint32)
_TIMES, _PLUS = _ODD[0] | np.uint32(1), _ODD[1]
_SEED = np.random.default_rng(21).integers(0, 2**63, SAMPLES, dtype=np.uint64)


class _Words(dict):
    """Hashes of words, kept while a batch lasts."""

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = xxhash.xxh3_64_digest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def shingle_set(data: bytes, known: _Words | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text in UTF-8."""
    words = data.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _Words() if known is None else known
    x = np.frombuffer(b"".join(map(known.__getitem__, words)), ">u8").astype(np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    if len(x) < WORDS:
        h = np.array([len(x)], np.uint64)
        for w in x:
            h = h * step + w
        return _mixed(h)
    h = x[:len(x) - WORDS + 1].copy()
    for i in range(1, WORDS):
        h = h * step + x[i:len(x) - WORDS + 1 + i]
    return np.unique(_mixed(h))


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a set that is not empty."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)[:, None]
    found = None
    for i in range(0, len(x), 256):
        part = (x[i:i + 256] * _TIMES + _PLUS).min(axis=0)
        found = part if found is None else np.minimum(found, part)
    return found


def band_keys(sampled: np.ndarray) -> np.ndarray:
    """A key for each band of each row; keys of different bands differ."""
    h = np.broadcast_to(_SEED[:BANDS], (len(sampled), BANDS))
    for r in range(ROWS):
        h = _mixed(h ^ sampled[:, r:BANDS * ROWS:ROWS].astype(np.uint64)) + _SEED[:BANDS]
    return h.view(np.int64)


def odd_sketches(sampled: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the samples, BITS bits as 64-bit numbers."""
    n = len(sampled)
    place = (_mixed(sampled.astype(np.uint64) + _SEED) % np.uint64(BITS)).astype(np.int64)
    flips = np.bincount((place + np.arange(n)[:, None] * BITS).ravel(), minlength=n * BITS).reshape(n, BITS) & 1
    return np.packbits(flips.astype(np.uint8), axis=1).view(np.int64)


def most_ones(least: int = LEAST, deviations: float = 5.0) -> int:
    """Ones in the XOR of two sketches beyond which a pair cannot be linked."""
    share = least / 100
    differing = 2 * SAMPLES * (1 - share)
    fade = math.exp(-2 * differing / BITS)
    of_samples = 4 * SAMPLES * share * (1 - share) * fade**2
    of_bits = BITS / 4 * (1 - fade**2) - differing * fade**2
    return math.ceil(BITS / 2 * (1 - fade) + deviations * math.sqrt(of_samples + max(of_bits, 0)))


def linked(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """The exact test on full sets."""
    if 100 * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= least * (len(a) + len(b) - common)


_LONGS = T.ArrayType(T.LongType())


def _profiles(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``seq``, ``n``, ``digest``, ``hash`` (of the text as it is)
    per row; ``bands`` and ``sketch`` at the first row of a set in its batch."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("hash", T.LongType()),
        T.StructField("bands", _LONGS), T.StructField("sketch", _LONGS),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, known = TaskContext.get().partitionId() << 36, _Words()
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known = _Words()
            sizes, digests, first, sampled = [], [], {}, []
            for row, data in enumerate(bytes_of(batch.column(1))):
                shingles = shingle_set(data, known)
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                sizes.append(len(shingles))
                digests.append(digest)
                if len(shingles) and digest not in first:
                    first[digest] = row
                    sampled.append(samples(shingles))
            rows = list(first.values())
            where = np.full(batch.num_rows, -1)
            where[rows] = np.arange(len(rows))
            some = np.array(sampled, np.uint32).reshape(-1, SAMPLES)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(seq + np.arange(batch.num_rows)), pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()), batch.column(2), _lists(band_keys(some), where), _lists(odd_sketches(some), where),
            ], names=schema.names)
            seq += batch.num_rows

    return map_batches(docs, work, schema)


def _lists(values: np.ndarray, where: np.ndarray) -> pa.Array:
    """Row ``where[i]`` of ``values`` as list i, null at -1."""
    width = values.shape[1]
    lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), width).cast(pa.list_(pa.int64()))
    return lists.take(pa.array(where, mask=where < 0))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` and ``kept``."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = stage(_profiles(docs), "profiles")
    some = rows.where("n > 0")
    classes = stage(some.groupBy("digest").agg(F.min(F.when(F.col("bands").isNotNull(), F.col("seq"))).alias("node")), "classes")
    nodes = stage(some.where("bands IS NOT NULL").join(
        classes.select(F.col("node").alias("seq")), "seq", "left_semi").withColumnRenamed("seq", "node"), "nodes")
    stars = stage(_star_links(docs, nodes, least), "links")
    first = stage(components(stars), "components")
    rest = stage(_rest_links(docs, nodes, first, least), "links")
    found = first
    if rest.head(1):
        found = stage(components(stars.unionByName(rest)), "components")
    joined = classes.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    members = some.select("doc_id", "seq", "n", "digest").join(joined, "digest")
    names = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    told = members.join(names, "component").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return told.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _buckets(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.posexplode("bands").alias("band", "bucket"), "node")


def _star_links(docs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """Confirmed links of nodes with nodes drawn from their buckets."""
    placed = _buckets(nodes).select("bucket", "node")
    # A different node for each bucket, so that a node meets many others of a large group.
    drawn = placed.groupBy("bucket").agg(
        F.min(F.struct(F.xxhash64("bucket", "node").alias("h"), "node"))["node"].alias("other"), F.count("*").alias("m"))
    pairs = placed.join(drawn.where("m > 1"), "bucket").where("node <> other").select("node", "other").distinct()
    ones = F.aggregate(F.zip_with("sketch", "other_sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    sketches = nodes.select("node", "sketch")
    near = pairs.join(sketches, "node").join(
        sketches.select(F.col("node").alias("other"), F.col("sketch").alias("other_sketch")), "other",
    ).select("node", "other", ones.alias("ones")).where(F.col("ones") <= most_ones(least))
    # At most one row per band and node is left to rank.
    closest = near.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("ones", "other"))), 1, CLOSEST).alias("c"))
    pairs = stage(closest.select("node", F.explode("c.other").alias("other")), "pairs")
    wanted = pairs.select("node").unionByName(pairs.select(F.col("other").alias("node"))).distinct()
    sets = stage(_sets_of(docs, nodes, wanted), "sets")
    both = pairs.join(sets, "node").join(
        sets.select(F.col("node").alias("other"), F.col("shingles").alias("other_shingles")), "other")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (c.to_pylist() for c in batch.columns)
            good = [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), least) for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v for v, g in zip(a, good) if g], pa.int64()), pa.array([v for v, g in zip(b, good) if g], pa.int64())],
                names=["a", "b"])

    return map_batches(both.select("node", "other", "shingles", "other_shingles"), work, _EDGES)


_EDGES = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``digest`` and ``text`` of nodes. They are found by id and hash of
    the text: equal texts have one node, so a row of ``docs`` meets at most one
    (but for colliding hashes), however many rows share an id or have none."""
    known = nodes.select("node", "digest", F.col("doc_id").alias("id"), F.col("hash").alias("of"))
    same = F.col("id").eqNullSafe(docs["doc_id"]) & (F.col("of") == docs["hash"])
    return known.join(docs, same).select("node", "digest", "text")


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``shingles`` (bytes of the sorted hashes) of ``wanted``."""
    rows = _texts_of(docs, nodes.join(wanted, "node", "left_semi"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known = _Words()
            node, shingles = [], []
            for n, digest, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), bytes_of(batch.column(2))):
                found = shingle_set(data, known).tobytes()
                # Another text may have the same id and hash; the digest tells them apart.
                if hashlib.blake2b(found, digest_size=16).digest() == digest:
                    node.append(n)
                    shingles.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(shingles, pa.binary())], names=["node", "shingles"])

    found = map_batches(rows, work, T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.BinaryType())]))
    return found.dropDuplicates(["node"])


def _rest_links(docs: DataFrame, nodes: DataFrame, first: DataFrame, least: int) -> DataFrame:
    """Confirmed links between different components of the star round."""
    known = nodes.select("node", "bands", "sketch").join(first, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "bands", "sketch")
    known = stage(known, "known")
    placed = known.select(F.posexplode("bands").alias("band", "bucket"), "node", "component").select("bucket", "node", "component")
    counted = placed.groupBy("bucket", "component").agg(F.count("*").alias("c"))
    open_ = counted.groupBy("bucket").agg(
        F.sum("c").alias("m"), F.count("*").alias("k"), F.max(F.struct("c", "component"))["component"].alias("main"))
    open_ = open_.where("k > 1").select("bucket", "main", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    held = placed.join(open_, "bucket").select(
        "bucket", "node", (F.col("component") != F.col("main")).alias("asks"), "blocks")
    # Every node answers in one block of its bucket; those outside the main component ask in all blocks.
    held = held.withColumn("home", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    answers = held.select("bucket", "node", F.col("home").alias("block"), "asks", F.lit(False).alias("only_asks"))
    asking = held.where("asks AND blocks > 1").select(
        "bucket", "node", "home", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asking = asking.where("block <> home").select("bucket", "node", "block", F.lit(True).alias("asks"), F.lit(True).alias("only_asks"))
    groups = stage(answers.unionByName(asking), "blocks")

    # By sketch: which nodes of a block may be linked there at all.
    by_sketch = _in_blocks(groups.join(known, "node"), None, least)
    maybe = stage(by_sketch, "maybe")
    if not maybe.head(1):
        return maybe.select(F.col("node").alias("a"), F.col("node").alias("b"))
    sets = stage(_sets_of(docs, nodes, maybe.select("node").distinct()), "sets")
    left = groups.join(maybe.distinct(), ["bucket", "block", "node"], "left_semi")
    return _in_blocks(left.join(known, "node"), sets, least)


def _in_blocks(rows: DataFrame, sets: DataFrame | None, least: int) -> DataFrame:
    """Compare those who ask with those who answer, block by block.

    Without ``sets``: ``bucket``, ``block``, ``node`` of all that a sketch may
    link. With them: confirmed links ``a``, ``b``, as many as it takes to join
    the components of a block.
    """
    columns = ["bucket", "block", "only_asks", "asks", "node", "component", "bands", "sketch"]
    if sets is not None:
        rows = rows.join(sets, "node")
        columns.append("shingles")
    # Answers come first, so a block holds them and lets those who only ask pass by.
    rows = rows.select(*columns).repartition("bucket", "block").sortWithinPartitions("bucket", "block", "only_asks")
    most, exact = most_ones(least), sets is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, out = None, None, []
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            cut = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            parts = [batch.slice(a, b - a) for a, b in zip(cut, cut[1:])]
            for key, part in zip([keys[a] for a in cut[:-1]], parts):
                if key != now:
                    if block is not None:
                        out += block.result()
                    now, block = key, _Block(*key, most, least, exact)
                block.add(part)
            if len(out) > 10_000:
                yield _told(out, exact)
                out = []
        if block is not None:
            out += block.result()
        yield _told(out, exact)

    schema = _EDGES if exact else T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("node", T.LongType())])
    return map_batches(rows, work, schema)


def _told(out: list[tuple], exact: bool) -> pa.RecordBatch:
    names, types = (["a", "b"], [pa.int64()] * 2) if exact else (
        ["bucket", "block", "node"], [pa.int64(), pa.int32(), pa.int64()])
    columns = zip(*out) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


class _Block:
    """The nodes that answer in one block of a bucket, and what was found."""

    def __init__(self, bucket: int, block: int, most: int, least: int, exact: bool) -> None:
        self.bucket, self.block, self.most, self.least, self.exact = bucket, block, most, least, exact
        self.answers: list[dict] = []
        self.table: dict | None = None
        self.band = -1
        self.found: set = set()
        self.joined: dict[int, int] = {}

    def add(self, part: pa.RecordBatch) -> None:
        only = np.array(part.column(2).to_pylist(), bool)
        rows = {
            "asks": np.array(part.column(3).to_pylist(), bool), "node": part.column(4).to_numpy(), "component": part.column(5).to_numpy(),
            "bands": _matrix(part.column(6)), "sketch": _matrix(part.column(7)),
            "shingles": np.array(part.column(8).to_pylist(), object) if self.exact else None,
        }
        pick = lambda keep: {k: None if v is None else v[keep] for k, v in rows.items()}
        if not only.all():
            self.answers.append(pick(~only))
            self.table = None
        if only.any():
            self._compare(pick(only), self._answers(), False)

    def result(self) -> list[tuple]:
        rows = self._answers()
        if rows is not None:
            ask = rows["asks"]
            self._compare({k: None if v is None else v[ask] for k, v in rows.items()}, rows, True)
        return sorted(self.found)

    def _answers(self) -> dict | None:
        if self.table is None and self.answers:
            whole = [np.concatenate([x[k] for x in self.answers]) if self.answers[0][k] is not None else None for k in self.answers[0]]
            self.table = dict(zip(self.answers[0], whole))
            self.answers = [self.table]
        return self.table

    def _root(self, component: int) -> int:
        while component in self.joined:
            component = self.joined[component]
        return component

    def _compare(self, ask: dict, answer: dict | None, inside: bool) -> None:
        if answer is None:
            return
        for i in range(len(ask["node"])):
            at = int(np.flatnonzero(ask["bands"][i] == self.bucket)[0])
            good = answer["component"] != ask["component"][i]
            # Two that both ask meet twice; the smaller node asks.
            good &= ~(answer["asks"] & (answer["node"] < ask["node"][i]))
            near = np.flatnonzero(good)
            if at and len(near):  # only in the first bucket that both share
                near = near[~(answer["bands"][near, :at] == ask["bands"][i, :at]).any(axis=1)]
            if not len(near):
                continue
            # As unsigned numbers: numpy counts the ones of a magnitude.
            ones = np.bitwise_count((answer["sketch"][near] ^ ask["sketch"][i]).view(np.uint64)).sum(axis=1)
            near = near[ones <= self.most]
            if not self.exact:
                if len(near):
                    self.found.add((self.bucket, self.block, int(ask["node"][i])))
                    self.found.update((self.bucket, self.block, int(n)) for n in answer["node"][near])
                continue
            mine = np.frombuffer(ask["shingles"][i], np.uint64)
            for j in near[np.argsort(ones[ones <= self.most], kind="stable")]:
                a, b = self._root(int(ask["component"][i])), self._root(int(answer["component"][j]))
                if a != b and linked(mine, np.frombuffer(answer["shingles"][j], np.uint64), self.least):
                    self.joined[max(a, b)] = min(a, b)
                    self.found.add((int(ask["node"][i]), int(answer["node"][j])))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are of one length, as rows."""
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1)


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with one document of each group; ids should be unique."""
    kept = near_groups(docs, doc_id, text, least).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs[doc_id].cast("long").eqNullSafe(kept["_id"]), "left_semi")
