"""Prefix trie of conversations by range minima over sorted LCPs (operator 11).

A conversation is a sequence of turns (role, text). Every distinct sequence of
first d turns is a node of depth d. Nothing builds a tree of objects:

* Turns become 16-byte keys, so texts are left behind after one sort by turn.
* Conversations are sorted by their key sequences, then by id, by a range
  partitioning of Spark. Equal conversations are neighbours, and one huge group
  of copies is cut by id. A partition is called a block.
* In the sorted order each prefix covers an interval, its members. The LCP of a
  row is the number of turns it shares with the row before it; a sparse table
  over the LCPs gives the minimum of any range at once. Each candidate prefix
  (row, depth) finds its left and its right end by its own binary search.
* A second sparse table, over one minimum per block, carries the searches over
  blocks: prefixes that leave their block are put together from one piece per
  block. There are at most as many such pieces as blocks times the longest
  prefix that two neighbouring blocks share.
* With intervals, counts become sums over positions: a leaf is an end of a run
  of equal conversations that no longer one follows, and the tokens saved below
  a node at words P before its last turn are the sum, over its members but the
  first, of the words that each shares with the row before it, minus P.

Defined cases: null roles and texts are empty; rows without a conversation id
belong to none and are left out; turns are ordered by number, null first, then
role, then text, and repeated rows are turns of their own; an empty table has no
node; other columns are ignored. While it is sorted, a conversation is one row
of 24 bytes a turn without texts, so texts and their lengths are unbounded and a
conversation may have some tens of millions of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import map_batches, prepare, stage

#: Turns of a block. A block is read whole by one task: 24 bytes a turn and some arrays of that length.
BLOCK_TURNS = 400_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_WORD = r"[^\x20\x09-\x0D]+"


def sequences(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """``conv_id`` and ``turns``, an array of (key, words) in order."""
    plain = rows.where(rows[conv_id].isNotNull()).select(
        rows[conv_id].alias("conv_id"), rows[turn].alias("turn"), F.coalesce(rows[role], F.lit("")).alias("role"),
        F.coalesce(rows[text], F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # The length of the role keeps ("a", "bc") and ("ab", "c") apart.
    key = F.substring(F.unhex(F.sha2(F.concat_ws("/", F.octet_length("role"), F.concat("role", "text")), 256)), 1, 16)
    turns = plain.select(
        "conv_id", F.row_number().over(order).alias("n"), key.alias("key"),
        F.size(F.regexp_extract_all("text", F.lit(_WORD), 0)).cast("long").alias("words"))
    return turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("n", "key", "words"))),
        lambda x: F.struct(x["key"].alias("key"), x["words"].alias("words"))).alias("turns"))


def rebranched(convs: DataFrame, every: int, head: Column) -> DataFrame:
    """Each conversation c with its first ``head`` turns taken from conversation
    c - c % ``every``; of an absent conversation there are none to take. ``head``
    is a condition on ``conv_id`` and at most 3."""
    own = convs.select("conv_id", "turns", head.cast("int").alias("head"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    bases = convs.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("first"))
    none = F.slice("turns", 1, 0)
    return own.join(bases, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("first", none), F.lit(1), F.col("head")),
        F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))).alias("turns"))


class SparseTable:
    """Minimum of any range of ``values`` from two overlapping powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [np.asarray(values)]
        width = 1
        while 2 * width <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def least(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minima of [first, end); the ranges must not be empty."""
        k = np.frexp((end - first).astype(float))[1] - 1
        found = np.empty(len(first), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            row = self.levels[level]
            found[at] = np.minimum(row[first[at]], row[end[at] - (1 << int(level))])
        return found

    def right_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each candidate the first place at or behind ``start`` whose value
        is below ``depth``, or the length, by binary search."""
        low, high = start.copy(), np.full(len(start), len(self.levels[0]), start.dtype)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            holds = np.zeros(len(start), bool)
            holds[open_] = self.least(start[open_], middle[open_] + 1) >= depth[open_]
            low = np.where(open_ & holds, middle + 1, low)
            high = np.where(open_ & ~holds, middle, high)
        return low

    def left_end(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each candidate the last place at or before ``start`` whose value
        is below ``depth``, or -1, by binary search."""
        low, high = np.full(len(start), -1, start.dtype), start.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            holds = np.zeros(len(start), bool)
            holds[open_] = self.least(middle[open_], start[open_] + 1) >= depth[open_]
            high = np.where(open_ & holds, middle - 1, high)
            low = np.where(open_ & ~holds, middle, low)
        return low


def _sorted_blocks(convs: DataFrame) -> DataFrame:
    """Conversations in sorted blocks: ``block``, ``place`` in it, ``conv_id``,
    ``turns`` and ``lcp`` with the row before, null for the first of a block."""
    turns = convs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    parts = max(1, -(-int(turns) // BLOCK_TURNS), min(convs.sparkSession.sparkContext.defaultParallelism, int(turns) // 2000))
    ordered = convs.select("conv_id", "turns").repartitionByRange(parts, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    types = T.StructType([T.StructField("block", T.LongType()), T.StructField("place", T.LongType()), *ordered.schema.fields,
                          T.StructField("lcp", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place, before = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, starts, sizes = _keys(batch.column(1))
            lcp = _shared(keys, starts, sizes, before)
            column = pa.array(lcp, pa.int64(), mask=np.arange(n) == 0 if before is None else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(place, place + n)), *batch.columns, column], names=types.names)
            place += n
            before = keys[starts[-1]:starts[-1] + sizes[-1]]

    return stage(map_batches(ordered, work, types), "trie-sorted")


def _keys(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all turns as pairs of numbers, where rows start, and their sizes."""
    starts = column.offsets.to_numpy().astype(np.int64)
    turns = column.values.slice(starts[0], starts[-1] - starts[0])
    keys = np.frombuffer(b"".join(turns.field("key").to_pylist()), np.int64).reshape(-1, 2)
    return keys, starts[:-1] - starts[0], np.diff(starts)


def _words(column: pa.ListArray) -> np.ndarray:
    starts = column.offsets.to_numpy()
    return column.values.slice(starts[0], starts[-1] - starts[0]).field("words").to_numpy().astype(np.int64)


def _shared(keys: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """LCP of each row with the row before; the first with ``before``."""
    if before is not None:
        keys, starts = np.concatenate([before, keys]), np.concatenate([[0], starts + len(before)])
        return _shared(keys, starts, np.concatenate([[len(before)], sizes]), None)[1:]
    found = sizes.copy()
    found[0] = 0
    if not len(keys):
        return found
    row = np.repeat(np.arange(len(sizes)), sizes)
    depth = np.arange(len(keys)) - np.repeat(starts, sizes)
    other = np.where(row > 0, starts[row - 1] + depth, 0)
    inside = (row > 0) & (depth < sizes[row - 1])
    differs = ~inside | (keys[np.arange(len(keys))] != keys[np.minimum(other, len(keys) - 1)]).any(axis=1)
    np.minimum.at(found, row[differs], depth[differs])
    found[0] = 0
    return found


def _outline(rows: DataFrame) -> list[tuple[int, int, int, int]]:
    """(block, rows, least LCP inside, LCP with the block before) per block: four
    numbers of each block, so the list grows with the number of partitions only."""
    ends = rows.groupBy("block").agg(
        F.count("*").alias("n"), F.min("lcp").alias("inner"), F.min_by("turns.key", "place").alias("first"),
        F.max_by("turns.key", "place").alias("last"))
    # One row per block: two sequences each.
    before = F.lag("last").over(Window.orderBy("block"))
    pairs = F.zip_with("before", "first", lambda a, b: ~a.eqNullSafe(b))
    shared = F.array_position(pairs, True) - 1
    told = ends.select("block", "n", "inner", "first", before.alias("before")).select(
        "block", "n", "inner", F.when(F.col("before").isNull(), -1).when(shared < 0, F.size("first")).otherwise(shared).alias("edge"))
    deep = np.iinfo(np.int64).max
    return [(r.block, r.n, deep if r.inner is None else r.inner, r.edge) for r in sorted(told.collect())]


_PIECES = T.StructType([
    # A node that stays in its block is whole; the others are pieces named by (owner, depth).
    T.StructField("whole", T.BooleanType()), T.StructField("owner", T.LongType()), T.StructField("depth", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("conv_id", T.LongType()), T.StructField("n_convs", T.LongType()),
    T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()), T.StructField("saved_tokens", T.LongType()),
    T.StructField("parent_conv_id", T.LongType()), T.StructField("parent_owner", T.LongType()),
    T.StructField("ends_sha256", T.StringType()), T.StructField("block", T.LongType()), T.StructField("ends", T.StringType()),
])


def _pieces(rows: DataFrame, outline: list[tuple[int, int, int, int]]) -> DataFrame:
    blocks = np.array([x[0] for x in outline], np.int64)
    offsets = np.concatenate([[0], np.cumsum([x[1] for x in outline])]).astype(np.int64)
    edges = np.array([x[3] for x in outline] + [-1], np.int64)
    # A prefix passes through a whole block if it is no deeper than this.
    through = SparseTable(np.minimum(np.array([x[2] for x in outline], np.int64), edges[:-1]))

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("place")
        at = int(np.searchsorted(blocks, table.column("block")[0].as_py()))
        column = table.column("turns").combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0)
        return _block(at, offsets[at], edges[at], edges[at + 1], through, table.column("conv_id").to_numpy(),
                      table.column("lcp").fill_null(0).to_numpy().copy(), column)

    prepare(rows.sparkSession)
    return rows.groupBy("block").applyInArrow(work, _PIECES)


def _block(at: int, offset: int, edge: int, next_edge: int, through: SparseTable, ids: np.ndarray, lcp: np.ndarray,
           column: pa.ListArray) -> pa.Table:
    """All nodes that begin in block ``at`` and the pieces in it of nodes that began before."""
    n = len(ids)
    _, starts, sizes = _keys(column)
    words = _words(column)
    lcp[0] = edge
    table, least_id = SparseTable(lcp), SparseTable(ids)
    # Words of the first k turns of row i: upto[starts[i] + k] - upto[starts[i]].
    upto = np.concatenate([[0], np.cumsum(words)])
    shared_words = upto[starts + np.maximum(lcp, 0)] - upto[starts]
    saved_upto = np.concatenate([[0], np.cumsum(shared_words)])
    leaf = np.append(lcp[1:], next_edge) < sizes
    leaves_upto = np.concatenate([[0], np.cumsum(leaf)])

    # Candidates: the prefixes that begin at a row, then those that came from the block before.
    fresh = sizes - lcp
    base = np.concatenate([[0], np.cumsum(fresh)])
    row = np.repeat(np.arange(n), fresh)
    depth = np.arange(base[-1]) - np.repeat(base[:-1], fresh) + np.repeat(lcp, fresh) + 1
    spine = np.arange(edge + 1)
    row, depth = np.concatenate([row, np.zeros(len(spine), np.int64)]), np.concatenate([depth, spine])
    inherited = np.arange(len(row)) >= base[-1]
    # The row itself may have a lower LCP; what counts is what follows it.
    end = table.right_end(row + 1, depth)
    leaves = (end == n) & (next_edge >= depth)
    before = np.maximum(depth - 1, 0)
    words_before = upto[starts[row] + before] - upto[starts[row]]
    # An inherited prefix has its first member elsewhere: all rows here count.
    counted = np.where(inherited, 0, row + 1)
    saved = saved_upto[end] - saved_upto[counted] - (end - counted) * words_before

    # Each prefix is a child of the one a turn shorter at the same row; only the
    # shortest that begins at a row has its parent at an earlier one.
    index = np.arange(len(row))
    shortest = ~inherited & (depth == lcp[row] + 1)
    place = np.full(len(row), -1, np.int64)
    place[~inherited & ~shortest] = index[~inherited & ~shortest] - 1
    up = np.flatnonzero(shortest & (depth > 0))
    left = table.left_end(row[up], depth[up] - 1)
    place[up] = np.where(left >= 0, base[np.maximum(left, 0)] + depth[up] - 2 - lcp[np.maximum(left, 0)], base[-1] + depth[up] - 1)
    inner = np.flatnonzero(inherited & (depth > 0))
    place[inner] = base[-1] + depth[inner] - 1
    has = np.flatnonzero((place >= 0) & ~inherited)
    children = np.bincount(place[has], minlength=len(row))

    # Pieces are named by the block in which their node begins.
    owner = np.full(len(row), at, np.int64)
    if len(spine):
        owner[inherited] = through.left_end(np.full(len(spine), at - 1, np.int64), spine)
    whole = ~inherited & ~leaves
    least = least_id.least(row, end)
    parent_known = (place >= 0) & whole[place]
    parent_id = np.where(parent_known, least[place], 0)
    parent_owner = np.where(place >= 0, owner[place], 0)

    # Members that end at a node stand first in its interval, in order of their ids.
    full = depth == sizes[row]
    same = np.concatenate([[False], (lcp[1:] == sizes[1:]) & (sizes[1:] == sizes[:-1])])
    breaks = np.append(np.flatnonzero(~same), n)
    run_end = breaks[np.searchsorted(breaks, np.arange(n), side="right")]
    hashes, ends = [EMPTY_SHA256] * len(row), [None] * len(row)
    for k in np.flatnonzero(full):
        told = ",".join(map(str, ids[row[k]:run_end[row[k]]].tolist()))
        if whole[k]:
            hashes[k] = hashlib.sha256(told.encode()).hexdigest()
        else:
            ends[k] = told
    return pa.Table.from_arrays([
        pa.array(whole), pa.array(owner), pa.array(depth), pa.array(offset + row, mask=inherited), pa.array(least), pa.array(end - row),
        pa.array(children), pa.array(leaves_upto[end] - leaves_upto[row]), pa.array(saved),
        pa.array(parent_id, mask=~parent_known), pa.array(parent_owner, mask=parent_known | (place < 0)),
        pa.array(hashes), pa.array(np.full(len(row), at)), pa.array(ends, pa.string()),
    ], schema=pa.schema([(f.name, {"boolean": pa.bool_(), "string": pa.string()}.get(f.dataType.typeName(), pa.int64())) for f in _PIECES]))


def _joined_ends(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of nodes in pieces, as a stream: a group
    of copies of any size passes piece by piece and only the state is held."""
    told = pieces.where("NOT whole AND ends IS NOT NULL").select("owner", "depth", "block", "ends")
    told = told.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block")
    types = T.StructType([T.StructField("owner", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("sha", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for owner, depth, ends in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (owner, depth) == now:
                    state.update(b",")
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (owner, depth), hashlib.sha256()
                state.update(ends.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, x)) for x in done], schema=_LINK)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, (*now, state.hexdigest())))], schema=_LINK)

    return map_batches(told, work, types)


_LINK = pa.schema([("owner", pa.int64()), ("depth", pa.int64()), ("sha", pa.string())])


def prefix_nodes(convs: DataFrame) -> DataFrame:
    """One row per node of the trie over ``convs`` (``conv_id`` long, ``turns``):
    the digest columns and ``first_place``, where its members begin in the sorted
    order; they are the ``n_convs`` rows from there."""
    rows = _sorted_blocks(stage(convs.select(F.col("conv_id").cast("long").alias("conv_id"), "turns"), "trie-convs"))
    outline = _outline(rows)
    if not outline:
        return rows.sparkSession.createDataFrame([], _RESULT)
    pieces = stage(_pieces(rows, outline), "trie-pieces")
    key = ["owner", "depth"]
    across = pieces.where("NOT whole").groupBy(*key).agg(
        F.min("start").alias("start"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in (
            "n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min(F.when(F.col("start").isNotNull(), F.col("parent_owner"))).alias("parent_owner"))
    across = stage(across.join(_joined_ends(pieces), key, "left").withColumn(
        "ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA256))).drop("sha"), "trie-across")
    columns = ["start", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "parent_owner"]
    nodes = pieces.where("whole").select(*columns, "parent_conv_id").unionByName(
        across.select(*columns, F.lit(None).cast("long").alias("parent_conv_id")))
    parents = across.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("found"))
    named = nodes.join(parents, ["parent_owner", "depth"], "left")
    return named.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256", F.col("start").alias("first_place"))


_RESULT = T.StructType([
    *(T.StructField(c, T.LongType()) for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    T.StructField("ends_sha256", T.StringType()), T.StructField("first_place", T.LongType())])
