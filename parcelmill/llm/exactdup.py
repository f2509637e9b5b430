"""Exact dedup with compressed radix tries (operator 7).

A key is the whole text as bytes, so texts with a common beginning share its
edges and equal texts share a terminal.

1. Where documents are read, each task inserts them into its own trie. A
   terminal stores the row that stays so far and how many rows it stands for.
   So a text with a third of all rows leaves each task as one entry.
2. These entries, the only rows that carry texts, go to owners by length and
   hash. An owner gets them in this order and inserts the full byte strings. When
   its trie is full and the next length and hash begins, all its texts are
   complete: they are handed on and freed. Spark's sort keeps on disk what does
   not fit.
3. Each row looks up what its terminal says.

Spill in step 1: when a trie holds more than ``budget`` bytes, edges and nodes
counted, or has a path of more than ``DEPTH`` nodes, its largest subtrees are handed on and forgotten; copies that come later
make a new entry, which the owner joins with the first. Results do not depend on it.

Equality of groups is decided by the byte strings, never by the hash alone;
``drop_copies`` finds the rows that stay by id and SHA-256. A very long text is
one entry of a trie, held whole in its task and hashed whole.

Defined cases: a null text is empty; a null id is smaller than any other;
repeated rows are copies of each other, and exactly one row of a group is
``kept`` even when ids are equal; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import bytes_of, drop_shared, map_batches, stage, write_shared

#: Only A-Z become small letters.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BUDGET = 48 << 20
#: Bytes that a node takes beside its edge: list, dictionary, row, digest. An estimate
#: from above for terminals; measured 570 on short rows.
NODE = 600
#: A trie with a path of more nodes is cut, as texts that are beginnings of each other
#: would make every insertion walk through all of them.
DEPTH = 512


class Trie:
    """A radix trie with compressed edges. A node is [edge, children, value]."""

    __slots__ = ("root", "held", "depth")

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.held = self.depth = 0

    def insert(self, key: bytes) -> list:
        """The terminal node of ``key``; its value is None when it is new."""
        node, at, steps = self.root, 0, 0
        while at < len(key):
            steps += 1
            child = node[1].get(key[at])
            if child is None:
                new = [key[at:], {}, None]
                node[1][key[at]] = new
                self.depth = max(self.depth, steps)
                self.held += len(new[0]) + NODE
                return new
            edge = child[0]
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            same = _common(edge, key, at)
            middle = [edge[:same], {edge[same]: child}, None]
            child[0] = edge[same:]
            node[1][key[at]] = middle
            self.held += NODE
            node, at = middle, at + same
        return node

    def terminals(self, node: list | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        todo = [(node or self.root, prefix)]
        while todo:
            node, prefix = todo.pop()
            key = prefix + node[0]
            if node[2] is not None:
                yield key, node[2]
            todo += [(child, key) for child in node[1].values()]

    def full(self, budget: int) -> bool:
        return self.held > budget or self.depth > DEPTH

    def split_off(self, most: int) -> Iterator[tuple[bytes, object]]:
        """Hand on and forget whole subtrees, largest first, until at most ``most``
        bytes are held. A subtree with more than half of all is cut further down."""
        self.depth = 0
        node, prefix = self.root, b""
        for _ in range(64):
            sizes = sorted(((_size(child), first) for first, child in node[1].items()), reverse=True)
            prefix += node[0]
            if not sizes or sizes[0][0] <= self.held // 2 or not node[1][sizes[0][1]][1]:
                break
            node = node[1][sizes[0][1]]
        else:
            sizes = sorted(((_size(child), first) for first, child in node[1].items()), reverse=True)
            prefix += node[0]
        for size, first in sizes:
            if self.held <= most:
                return
            self.held -= size
            yield from self.terminals(node[1].pop(first), prefix)


def _size(node: list) -> int:
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        total += len(node[0]) + NODE
        todo += node[1].values()
    return total


def _common(edge: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``edge`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(edge), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if edge[:middle] == key[at:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _better(a: tuple, b: tuple, largest: bool) -> tuple:
    """Of (id, row), the one that stays; a null id counts as the smallest id."""
    order = lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, -x[1])
    return max(a, b, key=order) if largest else min(a, b, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest",
                 budget: int = BUDGET, used: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256`` of the text with A-Z in small letters."""
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    largest = keep == "largest"
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    #: A row with ``seq`` is a document, one with ``text`` the entry ``rep`` of a task's trie.
    local = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("rep", T.LongType()),
        T.StructField("sha", T.BinaryType()), T.StructField("text", T.BinaryType()), T.StructField("rows", T.LongType()),
    ])
    types = pa.schema([("doc_id", pa.int64()), ("seq", pa.int64()), ("rep", pa.int64()), ("sha", pa.binary()),
                       ("text", pa.binary()), ("rows", pa.int64())])

    def entries(found: Iterator[tuple[bytes, list]], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
        part, held = [], 0
        for key, (best, rep, count, digest) in found:
            part.append((best[0], best[1], rep, digest, key, count))
            held += len(key)
            if held >= size:
                yield _batch(part, types)
                part, held = [], 0
        if part:
            yield _batch(part, types)

    def in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, seq = Trie(), TaskContext.get().partitionId() << 36
        for batch in batches:
            out = []
            for row, data in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
                data = data.translate(LOWER)
                digest = hashlib.sha256(data).digest()
                node = trie.insert(data)
                seq += 1
                if node[2] is None:
                    node[2] = [(row, seq), seq, 1, digest]
                else:
                    node[2][0] = _better(node[2][0], (row, seq), largest)
                    node[2][2] += 1
                out.append((row, seq, node[2][1], digest, None, None))
            yield _batch(out, types)
            if trie.full(budget):
                yield from entries(trie.split_off(min(budget, trie.held) // 2))
        yield from entries(trie.terminals())

    path = write_shared(map_batches(rows, in_tasks, local), "tries")
    if used is not None:
        used.append(path)
    seen = docs.sparkSession.read.schema(local).parquet(path)
    told = T.StructType([
        T.StructField("rep", T.LongType()), T.StructField("keep_id", T.LongType()),
        T.StructField("keep_seq", T.LongType()), T.StructField("group_size", T.LongType()),
    ])
    told_types = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keep_seq", pa.int64()), ("group_size", pa.int64())])

    def at_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, now = Trie(), None

        def done() -> list[tuple]:
            return [(rep, best[0], best[1], count) for _, (best, reps, count) in trie.terminals() for rep in reps]

        for batch in batches:
            out = []
            for row, seq, rep, digest, data, count in zip(*(c.to_pylist() for c in batch.columns)):
                if (digest, len(data)) != now:
                    if trie.full(budget // 4):  # complete: no later row has one of its texts
                        out += done()
                        trie = Trie()
                    now = digest, len(data)
                node = trie.insert(data)
                if node[2] is None:
                    node[2] = [(row, seq), [rep], count]
                else:
                    node[2][0] = _better(node[2][0], (row, seq), largest)
                    node[2][1].append(rep)
                    node[2][2] += count
            if out:
                yield _batch(out, told_types)
        yield _batch(done(), told_types)

    owned = seen.where(F.col("text").isNotNull()).withColumn("size", F.octet_length("text"))
    owned = owned.repartition("size", "sha").sortWithinPartitions("size", "sha")
    owners = map_batches(owned.select("doc_id", "seq", "rep", "sha", "text", "rows"), at_owners, told)
    members = seen.where(F.col("text").isNull()).select("doc_id", "seq", "rep", "sha")
    return members.join(owners, "rep").select(
        "doc_id", "keep_id", "group_size", (F.col("seq") == F.col("keep_seq")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they
    are, whatever their names. The owner's decision comes back by id and SHA-256
    of the text; of rows that agree in both, the one with the smallest hash of
    all columns stays."""
    from pyspark.sql import Window

    used: list[str] = []
    kept = exact_groups(docs, doc_id, text, keep, used=used).where("kept")
    key, nth, order = _unused(docs, "_key"), _unused(docs, "_nth"), _unused(docs, "_order")
    kept = stage(kept.select(_id_and_sha(F.col("doc_id"), F.col("text_sha256")).alias(key)), "kept")
    for path in used:  # the decisions are written, the tries have done their work
        drop_shared(docs.sparkSession, path)
    plain = F.translate(F.coalesce(docs[text], F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = [docs[f.name] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = docs.withColumns({key: _id_and_sha(docs[doc_id].cast("long"), F.sha2(plain, 256)), order: F.xxhash64(*hashed)})
    found = keyed.join(kept, key, "left_semi")
    # Rows repeated with their id are copies as well. One key, so one shuffle of the texts.
    first = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return found.withColumn(nth, first).where(F.col(nth) == 1).drop(key, nth, order)


def _id_and_sha(number: Column, sha: Column) -> Column:
    return F.concat_ws("/", F.coalesce(number.cast("string"), F.lit("")), sha)


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name
