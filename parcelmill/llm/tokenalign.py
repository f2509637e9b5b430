"""Alignment of two tokenizers by common token ends (operator 12).

A text is encoded by a byte-level tokenizer (A) and by a piece model (B). For
each side a dictionary leads from the byte offset where a token ends to the
number of tokens up to there. The intersection of the two key sets, sorted, cuts
both id lists into groups of the same bytes, and inside a group every pair of
tokens with overlapping byte ranges is a link. How often a pair of ids is linked
in the whole corpus comes back to each document.

Texts are cut before single spaces and line breaks that stand between characters
that are not white space: there both tokenizers begin a new token whatever is
around, so a part has the same ids and groups everywhere and is aligned once as
long as a task remembers it. Texts with other white space go to the libraries
whole, and so do all if the tokenizers are of another kind.

Links are not shuffled one by one. A block, the texts of one Arrow batch, keeps
a dictionary of its distinct pairs; its documents hold places in it. Only the
dictionaries are summed up over the corpus and joined with the sums, so a pair
that every document holds costs one row per block, and each block reads back the
counts of its own pairs, whatever the size of the whole table of pairs.

Defined cases: a null or empty text, and a text that either tokenizer does not
give back byte for byte behind one space, has no tokens; repeated rows count as
often as they occur; null and repeated ids are kept; an empty table gives no
rows; other columns are ignored, whatever their names. A very long text is a
block of its own and is taken whole; the libraries need some hundred bytes of
memory per token of it.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import map_batches, prepare, stage, texts_of
from parcelmill.llm.pieces import Memory, read_model

SPACE = "▁"
#: Parts that a task remembers, twice this at most, and the longest of them.
PARTS, LONGEST_PART = 120_000, 64
#: Parts that are encoded as one text, and the word in front of them.
TOGETHER, FIRST = 1000, "a"
MARKS = frozenset(".,;:!?")
_LOOSE = re.compile(rf"\s\s|^\s|\s$|{SPACE}")
#: Characters that the libraries are given at once.
CHUNK = 1 << 20


def _byte_alphabet() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for 256, 257 and so on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Pair:
    """Both tokenizers with the bytes of each id."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = _byte_alphabet()
        entries = {i: bytes(alphabet[c] for c in entry) for entry, i in spec["model"]["vocab"].items()}
        for token in spec.get("added_tokens") or []:
            entries[token["id"]] = token["content"].encode()
        self.a_bytes = [entries.get(i, b"") for i in range(max(entries) + 1)]
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace(SPACE, " ").encode() for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        self.splits = self._splits(spec, pieces)
        self.forget()

    def forget(self) -> None:
        """Drop the aligned parts, so that an idle worker holds little memory."""
        self.parts = Memory(PARTS)

    def _splits(self, spec: dict, pieces: str) -> bool:
        """Whether both always begin a token at the places where texts are cut."""
        before = spec.get("pre_tokenizer") or {}
        try:
            model = read_model(pieces)
        except ValueError:
            return False
        #: Neighbours inside some piece; no piece joins any other two characters.
        self.joins = {p[i:i + 2] for p in model.pieces for i in range(len(p) - 1)}
        return (spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                and not before.get("add_prefix_space"))

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B for each text, none for texts that do not come back."""
        chunk: list[str] = []
        size = 0
        for i, text in enumerate(texts):
            chunk.append(text)
            size += len(text)
            if size >= CHUNK or i == len(texts) - 1:
                yield from self._encode(chunk)
                chunk, size = [], 0

    def _encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        a = self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        for text, x, y in zip(texts, a, b):
            ids, want = x.ids, b" " + text.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, ids)) == want == b"".join(map(self.b_bytes.__getitem__, y))
            yield (ids, y) if same else ([], [])


    def encode_parts(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of parts, see ``_segments``."""
        a = self.a.encode_batch_fast([x if x[:1] == "\n" else " " + x for x in parts], add_special_tokens=False)
        b = self.b.encode(parts, num_threads=1)
        for part, x, y in zip(parts, a, b):
            ids, want = x.ids, part.encode()
            if part[:1] == "\n":
                y = y[1:]  # the dummy space, which no piece joins with a line break
            else:
                want = b" " + want
            same = b"".join(map(self.a_bytes.__getitem__, ids)) == want == b"".join(map(self.b_bytes.__getitem__, y))
            yield (ids, y) if same else ([], [])


    @lru_cache(maxsize=16)
    def mark(self, c: str) -> Aligned:
        """A mark behind a letter, aligned without a space in front."""
        a = self.a.encode(c, add_special_tokens=False).ids
        return _aligned(a, self.b.encode("\n" + c)[2:], self)


@lru_cache(maxsize=2)
def pair_of(byte_level: str, pieces: str) -> Pair:
    """Kept by a Python worker from task to task."""
    made = Pair(byte_level, pieces)
    gc.freeze()  # its many small parts live as long as the worker
    return made


def cuts(a_sizes: list[int], b_sizes: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Where groups end, as numbers of tokens of A and of B, and all token ends."""
    a_ends, b_ends = list(accumulate(a_sizes)), list(accumulate(b_sizes))
    a_at, b_at = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return list(map(a_at.__getitem__, common)), list(map(b_at.__getitem__, common)), a_ends, b_ends


def links_of(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int]) -> list[int]:
    """Linked ids of one group as ``a << 32 | b``: the token that ends first gives way to the next."""
    if len(a) == 1 or len(b) == 1:
        return [x << 32 | y for x in a for y in b]
    found, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        found.append(a[i] << 32 | b[j])
        x, y = a_ends[i], b_ends[j]
        i += x <= y
        j += y <= x
    return found


def align_ids(a: list[int], b: list[int], pair: Pair) -> tuple[array, list[str]]:
    """Links of one text and its groups as texts ``a1,a2|b1``."""
    codes, groups = array("q"), []
    if not a:
        return codes, groups
    a_cuts, b_cuts, a_ends, b_ends = cuts(list(map(pair.a_sizes.__getitem__, a)), list(map(pair.b_sizes.__getitem__, b)))
    i = j = 0
    for m, n in zip(a_cuts, b_cuts):
        if m - i == 1 and n - j == 1:
            codes.append(a[i] << 32 | b[j])
            groups.append(f"{a[i]}|{b[j]}")
        else:
            x, y = a[i:m], b[j:n]
            codes.extend(links_of(x, y, a_ends[i:m], b_ends[j:n]))
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
        i, j = m, n
    return codes, groups


#: Numbers of A ids, B ids and groups, groups as text, links as bytes.
Aligned = tuple[int, int, int, str, bytes]
_NONE: Aligned = (0, 0, 0, "", b"")


def _aligned(a: list[int], b: list[int], pair: Pair) -> Aligned:
    codes, groups = align_ids(a, b, pair)
    return len(a), len(b), len(groups), ";".join(groups), codes.tobytes()


def align_parts(parts: list[str], pair: Pair) -> list[Aligned]:
    """Each part aligned, see ``_segments``. They are encoded as one text, whose
    groups end wherever a part does; where that text does not come back, one by one."""
    text = "".join([p if p[:1] == "\n" else " " + p for p in (FIRST, *parts)])
    (a, b), = pair.encode([text[1:]])
    found = _split(a, b, list(accumulate([len(p.encode()) + (p[:1] != "\n") for p in (FIRST, *parts)])), pair) if a else []
    if len(found) != len(parts) + 1:
        return [_aligned(a, b, pair) for a, b in pair.encode_parts(parts)]
    return found[1:]


def _split(a: list[int], b: list[int], ends: list[int], pair: Pair) -> list[Aligned]:
    """The aligned pieces of one text that end at ``ends``, up to the first end that is none of a group."""
    a_cuts, b_cuts, a_ends, b_ends = cuts(list(map(pair.a_sizes.__getitem__, a)), list(map(pair.b_sizes.__getitem__, b)))
    found, codes, groups = [], [], []
    i = j = a_from = b_from = 0
    left = iter(ends)
    end = next(left)
    for m, n in zip(a_cuts, b_cuts):
        if m - i == 1 and n - j == 1:
            codes.append(a[i] << 32 | b[j])
            groups.append(f"{a[i]}|{b[j]}")
        else:
            x, y = a[i:m], b[j:n]
            codes += links_of(x, y, a_ends[i:m], b_ends[j:n])
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
        i, j = m, n
        if a_ends[m - 1] == end:
            found.append((m - a_from, n - b_from, len(groups), ";".join(groups), array("q", codes).tobytes()))
            a_from, b_from, codes, groups, end = m, n, [], [], next(left, 0)
    return found


def _joined(parts: Iterable[Aligned]) -> Aligned:
    a, b, groups, names, codes = zip(*parts)
    # A part that does not come back has no tokens.
    return (sum(a), sum(b), sum(groups), ";".join(names), b"".join(codes)) if all(a) else _NONE


def _segments(text: str) -> list[str]:
    """Parts of a text, each named by what follows its space; those behind a line break begin with it."""
    return text.replace("\n", " \n").split(" ")


def align_texts(texts: list[str], pair: Pair) -> list[Aligned]:
    """Each text aligned, part by part where it can be cut."""
    found = [_NONE] * len(texts)
    whole = [i for i, t in enumerate(texts) if t and (not pair.splits or _LOOSE.search(t))]
    for i, (a, b) in zip(whole, pair.encode([texts[i] for i in whole])):
        found[i] = _aligned(a, b, pair) if a else _NONE
    rest = set(whole)
    cut = {i: _segments(t) for i, t in enumerate(texts) if t and i not in rest}
    known: dict[str, Aligned] = {}
    new = []
    for part in set().union(*cut.values()):
        told = pair.parts.get(part)
        if told is None:
            new.append(part)
        else:
            known[part] = told
    # A letter and a mark behind it never share a token of A; where no piece joins them either, they are aligned apart.
    marked = {p: p[:-1] for p in new if p[-1:] in MARKS and p[-2:-1].isalpha() and p[-2:] not in pair.joins}
    heads = {h: pair.parts.get(h) for h in set(marked.values()) if h not in known}
    new = [p for p in new if p not in marked and p not in heads] + [h for h, told in heads.items() if told is None]
    known.update((h, told) for h, told in heads.items() if told is not None)
    short = [p for p in new if len(p) <= LONGEST_PART]
    for k in range(0, len(short), TOGETHER):
        for part, told in zip(short[k:k + TOGETHER], align_parts(short[k:k + TOGETHER], pair)):
            known[part] = told
            pair.parts.put(part, told)
    long = [p for p in new if len(p) > LONGEST_PART]
    known.update((p, _aligned(a, b, pair)) for p, (a, b) in zip(long, pair.encode_parts(long)))
    for part, head in marked.items():
        known[part] = told = _joined([known[head], pair.mark(part[-1])])
        if len(part) <= LONGEST_PART:
            pair.parts.put(part, told)
    for i, parts in cut.items():
        found[i] = _joined(map(known.__getitem__, parts))
    return found


def align(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``a_ids``, ``b_ids``, and where the groups end in each list
    (``a_cuts``, ``b_cuts``). The files must be readable on every executor."""
    plain = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    ints = T.ArrayType(T.IntegerType())
    names = ["a_ids", "b_ids", "a_cuts", "b_cuts"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_level, pieces)
        for batch in batches:
            found = [(a, b, *cuts(list(map(pair.a_sizes.__getitem__, a)), list(map(pair.b_sizes.__getitem__, b)))[:2])
                     for a, b in pair.encode(texts_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in range(4))], names=["doc_id", *names])

    return map_batches(plain, work, T.StructType([plain.schema["doc_id"], *(T.StructField(n, ints) for n in names)]))


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(plain: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """A row per document with the places of its links in the dictionary of its
    block, and a row per block with that dictionary."""
    longs = T.ArrayType(T.LongType())
    types = T.StructType([
        T.StructField("block", T.LongType()), plain.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in _NUMBERS),
        T.StructField("groups_sha256", T.StringType()), T.StructField("places", T.BinaryType()),
        T.StructField("pairs", longs), T.StructField("times", longs)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_level, pieces)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            block += 1
            aligned = align_texts(texts_of(batch.column(1)), pair)
            rows = [(a, b, n, len(codes) // 8, hashlib.sha256(names.encode()).hexdigest() if n else "")
                    for a, b, n, names, codes in aligned]
            pairs, places, times = np.unique(
                np.frombuffer(b"".join(x[4] for x in aligned), np.int64), return_inverse=True, return_counts=True)
            places = places.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
            ends = np.cumsum([r[3] for r in rows])
            told = [places[e - r[3]:e].tobytes() for r, e in zip(rows, ends)]
            n, none = len(rows), pa.nulls
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n), batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4)),
                 pa.array([r[4] for r in rows]), pa.array(told, pa.binary()), none(n, pa.list_(pa.int64())), none(n, pa.list_(pa.int64()))],
                names=types.names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), none(1, batch.column(0).type), *(none(1, pa.int64()) for _ in range(4)), none(1, pa.string()),
                 none(1, pa.binary()), pa.array([pairs], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64()))], names=types.names)
        pair.forget()

    return map_batches(plain, work, types)


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """``pair``, how many links of the corpus hold it, and whether no other A id
    is linked more often with its B id. A B id has at most as many rows as A has ids."""
    summed = dictionaries.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).groupBy("pair").agg(F.sum("times").alias("total"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    return summed.select("pair", "total", (F.col("total") == F.max("total").over(Window.partitionBy(b))).alias("best"))


def align_counts(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum`` and ``groups_sha256``."""
    plain = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    rows = stage(_blocks(plain, byte_level, pieces), "token-links")
    texts = rows.where("pairs IS NULL").drop("pairs", "times")
    dictionaries = rows.where("pairs IS NOT NULL").select("block", "pairs", "times")
    placed = dictionaries.select("block", F.posexplode("pairs").alias("place", "pair"))
    known = placed.join(pair_counts(dictionaries), "pair").select(F.col("block").alias("of_block"), "place", "total", "best")
    out = T.StructType([plain.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in (*_NUMBERS, "n_best", "count_sum")),
                        T.StructField("groups_sha256", T.StringType())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        place = right.column("place").to_numpy()
        total[place], best[place] = right.column("total").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        sums = [[], []]
        for x in left.column("places").to_pylist():
            at = np.frombuffer(x, kind)
            sums[0].append(int(best[at].sum()))
            sums[1].append(int(total[at].sum()))
        return pa.Table.from_arrays(
            [left.column("doc_id"), *(left.column(n) for n in _NUMBERS), *(pa.array(s, pa.int64()) for s in sums),
             left.column("groups_sha256")], names=out.names)

    prepare(docs.sparkSession)
    return texts.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(work, out)
