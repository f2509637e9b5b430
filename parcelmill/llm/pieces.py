"""SentencePiece encoding and decoding by a weighted transducer (operator 9).

The transducer is the composition of three parts:

* the normaliser: a dummy space in front, every space written as U+2581, all
  other characters as they are;
* the pieces: a trie over normalised characters that puts out piece ids;
* byte fallback: a character that no piece covers puts out its UTF-8 bytes.

Composed with an input it is a lattice whose states are (position, last piece).
An arc that appends a piece weighs 0 if merging the two pieces' text by the
model's scores gives these two pieces again, and infinity otherwise. A sequence
in which all neighbours are stable in this sense is what merging the whole
text gives, and there is exactly one. So in the tropical semiring the shortest
path has weight 0, is unique, and equals the model's own encoding; every
position has one live state, which makes the search linear in the text. Weights
of pairs are worked out when first met and kept.

No piece of such a model has a space mark behind another character, or a line
break at all, so a lattice falls apart before every run of spaces and every line
break; equal parts are solved once as long as a worker remembers them. This is
checked when a model is compiled; a model that is not of this kind (unigram,
other normalisers, no dummy space, such pieces) is refused.

Decoding is the same transducer read the other way.

Defined cases: a null or empty text has no ids and decodes to an empty text; a
literal U+2581 is a space to the model and decodes to a space, every other text
comes back exactly; repeated rows are encoded each; other columns are kept, and
an input column with the name of an output is refused. Texts are taken whole;
nothing is shuffled.
"""

from __future__ import annotations

import gc
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelmill.llm.common import map_batches, texts_of

SPACE = "▁"
#: Entries a task keeps of solved parts, and a worker of weights of pairs.
PARTS, PAIRS, LONGEST_PART = 100_000, 250_000, 48
DECODED_IDS = 200_000
_UNKNOWN, _TRIED = 1 << 20, -2
_RUNS = re.compile(" +[^ ]*")


@dataclass(frozen=True)
class Model:
    """What a model file holds: pieces with scores and kinds, and settings."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]  # 1 plain, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbered fields of one message of the model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at:at + size]
            at += size


def read_model(path: str) -> Model:
    with open(path, "rb") as file:
        data = file.read()
    pieces, scores, kinds, merges = [], [], [], False
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, 1))
        elif number == 2:
            spec = dict(_fields(value))
            merges = spec.get(3, 1) == 2
            if not spec.get(35, 0):
                raise ValueError("a model without byte fallback is not supported")
        elif number == 3:
            spec = dict(_fields(value))
            if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1) or not spec.get(3, 1):
                raise ValueError("only the normaliser that keeps all characters behind a dummy space is supported")
    model = Model(tuple(pieces), tuple(scores), tuple(kinds))
    if not merges or any(k in (4, 5) for k in kinds):
        raise ValueError("only models that merge pairs, without user-defined or unused pieces, are supported")
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p, k in zip(pieces, kinds) if k == 1):
        raise ValueError("a piece has a space behind another character, or a line break")
    return model


class Memory:
    """Keeps what was used lately: when the young half is full, it becomes the
    old half and what only the old half had is forgotten."""

    def __init__(self, half: int) -> None:
        self.half, self.young, self.old = half, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young
        self.young[key] = value


class Transducer:
    def __init__(self, path: str) -> None:
        self.model = model = read_model(path)
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == 1}
        self.bytes = [0] * 256
        for i, (p, k) in enumerate(zip(model.pieces, model.kinds)):
            if k == 6:
                self.bytes[int(p[3:5], 16)] = i
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        #: The longest piece that a beginning of a piece begins with, -1 for none.
        self.best: dict[str, int] = {}
        self.longest = max(map(len, self.ids))
        for p in self.ids:
            self.trie.add_word(p)
        for p in self.ids:
            for k in range(1, len(p) + 1):
                if p[:k] not in self.best:
                    self.best[p[:k]] = self.ids.get(p[:k], self.best.get(p[:k - 1], -1))
        #: Of each piece, the next shorter piece that it begins with.
        self.shorter = {i: self.best.get(p[:-1], -1) for p, i in self.ids.items()}
        self.sizes = {i: len(p) for p, i in self.ids.items()}
        #: Neighbours inside some piece; between any other two characters a part may be cut.
        self.joins = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.pairs: dict[int, bool] = {}
        self.forget()
        self.out = [self._surface(p, k) for p, k in zip(model.pieces, model.kinds)]
        self.out_sizes = np.array([len(x) for x in self.out], np.int64)
        self.out_at = np.concatenate([[0], np.cumsum(self.out_sizes)[:-1]])
        self.out_bytes = np.frombuffer(b"".join(self.out), np.uint8)

    def forget(self) -> None:
        """Drop the solved parts, so that an idle worker holds little memory."""
        self.parts, self.runs = Memory(PARTS), Memory(PARTS)

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == 6:
            return bytes([int(piece[3:5], 16)])
        if kind == 3:
            return b""
        return " ⁇ ".encode() if kind == 2 else piece.replace(SPACE, " ").encode()

    def _merge(self, text: str) -> list[str]:
        """The pieces that merging by score leaves of a short text."""
        parts = list(text)
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                k = self.ids.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.model.scores[k] > best):
                    best, at = self.model.scores[k], i
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _text(self, token: int) -> str:
        return chr(token - _UNKNOWN) if token >= _UNKNOWN else self.model.pieces[token]

    def _stable(self, before: int, token: int) -> bool:
        """Whether the arc from ``before`` (-1: the beginning) to ``token`` weighs 0."""
        pieces = [self._text(t) for t in (before, token) if t >= 0]
        found = self._merge("".join(pieces)) == pieces
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[before << 22 | token] = found
        return found

    def path(self, text: str) -> list[int]:
        """Tokens of the shortest path for a normalised text; characters
        without a piece are ``_UNKNOWN`` plus their code point.

        Depth first along arcs of weight 0, longest first. A place has one
        prefix path of weight 0, so one that leads no further is never tried
        again and the search is linear.
        """
        at, before, closed, taken = 0, -1, set(), []
        pairs, shorter, sizes, reach = self.pairs, self.shorter, self.sizes, self.longest
        begins, best, n = self.trie.longest_prefix, self.best, len(text)
        token = None
        while at < n:
            if token is None:
                ahead = text[at:at + reach]
                token = best.get(ahead[:begins(ahead)], -1)
            while True:
                if token < 0:
                    # No piece fits; a character without a piece still may.
                    token = -1 if text[at] in self.ids or token == _TRIED else _UNKNOWN + ord(text[at])
                    if token < 0:
                        break
                end = at + sizes.get(token, 1)
                if end not in closed:
                    fits = pairs.get(before << 22 | token)
                    if fits is None:
                        fits = self._stable(before, token)
                    if fits:
                        break
                token = shorter.get(token, _TRIED)
            if token >= 0:
                taken.append((at, before, token))
                at, before, token = end, token, None
            else:
                closed.add(at)
                at, before, token = taken.pop()
                token = shorter.get(token, _TRIED)
        return [token for _, _, token in taken]

    def _solve(self, part: str) -> bytes:
        """Ids of a part as bytes, run by run between places that no piece joins."""
        joins, runs = self.joins, self.runs
        ids = runs.get(part)
        if ids is not None:
            return ids
        if part[-2:] not in joins:  # mostly a word and a point or comma
            head, tail = runs.get(part[:-1]), runs.get(part[-1])
            if head is not None and tail is not None:
                return head + tail
        cuts = [0, *(i for i in range(1, len(part)) if part[i - 1:i + 1] not in joins), len(part)]
        found = []
        for i, j in zip(cuts, cuts[1:]):
            run = part[i:j]
            ids = runs.get(run)
            if ids is None:
                ids = self._ids(run)
                if len(run) <= LONGEST_PART:
                    runs.put(run, ids)
            found.append(ids)
        return b"".join(found)

    def _ids(self, run: str) -> bytes:
        ids = array("i")
        for token in self.path(run):
            if token >= _UNKNOWN:
                ids.extend([self.bytes[b] for b in chr(token - _UNKNOWN).encode()])
            else:
                ids.append(token)
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        text = text.replace(SPACE, " ")
        # A part is named by what follows its first space; a line break gets a space to begin a part.
        text = text.replace("\n", " \n")
        parts = [x[1:] for x in _RUNS.findall(" " + text)] if "  " in text or text[0] == " " else text.split(" ")
        known = self.parts
        found = list(map(known.young.get, parts))
        if None in found:
            for i, (p, x) in enumerate(zip(parts, found)):
                if x is None:
                    x = known.get(p)
                    if x is None:
                        whole = p.replace(" ", SPACE)
                        x = self._solve(whole if "\n" in p else SPACE + whole)
                        if len(p) <= LONGEST_PART:
                            known.put(p, x)
                    found[i] = x
        return np.frombuffer(b"".join(found), np.int32)

    def surfaces(self, ids: np.ndarray, ends: np.ndarray) -> pa.StringArray | None:
        """Texts of rows of ids that end at ``ends``, gathered from the bytes of
        all pieces at once; None if the bytes of some row are no text."""
        sizes = self.out_sizes[ids]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        data = self.out_bytes[np.arange(upto[-1]) + np.repeat(self.out_at[ids] - upto[:-1], sizes)]
        cuts = np.concatenate([[0], upto[ends]])
        # The dummy space in front of a row goes.
        first = cuts[:-1][cuts[:-1] < cuts[1:]]
        first = first[data[first] == 32]
        cuts = cuts - np.searchsorted(first, cuts)
        made = pa.StringArray.from_buffers(
            len(ends), pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(np.delete(data, first))))
        try:
            made.validate(full=True)
        except pa.ArrowInvalid:
            return None
        return made

    def decode(self, ids) -> str:
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ")


@lru_cache(maxsize=2)
def transducer_of(path: str) -> Transducer:
    """Kept by a Python worker from task to task."""
    made = Transducer(path)
    gc.freeze()  # its many small parts live as long as the worker
    return made


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the piece ids of each text. ``model`` is a file that every
    executor can read."""
    return _with(docs, {ids: T.ArrayType(T.IntegerType())}, text, model, lambda x, t: [_encode_column(x, t)])


def decode(rows: DataFrame, model: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids; null counts as no ids."""
    return _with(rows, {text: T.StringType()}, ids, model, lambda x, t: [_decode_column(x, t)])


def encode_and_decode(docs: DataFrame, model: str, text: str = "text", ids: str = "token_ids",
                      decoded: str = "decoded") -> DataFrame:
    """``encode``, then ``decode`` of what it gave, in one pass of the same workers."""
    def both(column: pa.Array, transducer: Transducer) -> list[pa.Array]:
        found = _encode_column(column, transducer)
        return [found, _decode_column(found, transducer)]

    return _with(docs, {ids: T.ArrayType(T.IntegerType()), decoded: T.StringType()}, text, model, both)


def _encode_column(column: pa.Array, transducer: Transducer) -> pa.Array:
    found = [transducer.encode(x) for x in texts_of(column)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))


def _decode_column(column: pa.Array, transducer: Transducer) -> pa.Array:
    if column.null_count or not len(column):
        return pa.array(["" if not x.is_valid else transducer.decode(x.values.to_pylist()) for x in column], pa.string())
    offsets = column.offsets.to_numpy().astype(np.int64)
    ids = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    made = []
    # Some hundred thousand ids at once; a longer row alone.
    cuts = [0]
    for i in range(1, len(column) + 1):
        if offsets[i] - offsets[cuts[-1]] >= DECODED_IDS or i == len(column):
            cuts.append(i)
    for i, j in zip(cuts, cuts[1:]):
        part = ids.slice(offsets[i] - offsets[0], offsets[j] - offsets[i])
        found = None if part.null_count else transducer.surfaces(part.to_numpy(), offsets[i + 1:j + 1] - offsets[i])
        if found is None:
            found = pa.array([transducer.decode(x.values.to_pylist()) for x in column.slice(i, j - i)], pa.string())
        made.append(found)
    return pa.concat_arrays(made)


def _with(rows: DataFrame, new: dict[str, T.DataType], source: str, model: str, work_columns) -> DataFrame:
    for name in new:
        if name in rows.columns:
            raise ValueError(f"the input already has a column {name!r}")
    at = rows.columns.index(source)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = transducer_of(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *work_columns(batch.column(at), transducer)], names=[*batch.schema.names, *new])
        transducer.forget()

    return map_batches(rows, work, T.StructType([*rows.schema.fields, *(T.StructField(k, v) for k, v in new.items())]))
