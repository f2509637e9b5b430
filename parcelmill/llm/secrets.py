"""Secret scans with one combined deterministic automaton (operator 8).

The regexes of all rules are parsed, joined into one NFA, turned into a DFA by
subset construction and made minimal by partition refinement. The DFA is a flat
transition array over bytes; one pass over the UTF-8 bytes of a text tells at
which byte a match of which rules ends. There, and only there, a backward
automaton of that rule finds the leftmost start and its forward automaton the
longest end. Spans are given in code points.

Each rule reports leftmost, longest, non-overlapping matches. That equals a
backtracking regex engine for rules whose repeats are greedy and where a match
never begins inside another one and first ends before it; the rules here have
this form and are tested against ``re``.

Defined cases: a null text is empty and gives zero counts; repeated documents
are scanned each; extra columns are ignored; an empty table gives no rows. Each
text is scanned whole, in memory of its own size; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from parcelmill.llm.common import bytes_of, map_batches


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``; a match counts if the body has ``least_body``
    and the whole match ``least`` bytes."""

    kind: str
    head: str
    body: str
    least: int = 0
    least_body: int = 0


#: The base rules of the scan, in the order in which kinds are listed.
RULES = (
    Rule("assign",
         "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
         "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?",
         "[A-Za-z0-9+/_.=-]+", least_body=6),
    Rule("access", "AKIA", "[A-Z0-9]+", least=20),
    Rule("hex", "", "[0-9a-f]+", least=24),
)


# --- regex to NFA -----------------------------------------------------------


class Nfa:
    """States are numbers; ``step[s]`` lists (byte set, next), ``free[s]`` next."""

    def __init__(self) -> None:
        self.step: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def add(self, node, start: int, end: int) -> None:
        kind = node[0]
        if kind == "set":
            self.step[start].append((node[1], end))
        elif kind == "seq":
            parts = node[1]
            for i, part in enumerate(parts):
                after = end if i == len(parts) - 1 else self.state()
                self.add(part, start, after)
                start = after
            if not parts:
                self.free[start].append(end)
        elif kind == "or":
            for part in node[1]:
                a, b = self.state(), self.state()
                self.free[start].append(a)
                self.free[b].append(end)
                self.add(part, a, b)
        else:  # repeat
            _, inner, least, most = node
            for _ in range(least):
                after = self.state()
                self.add(inner, start, after)
                start = after
            a, b = self.state(), self.state()
            self.free[start] += [a, end]
            self.free[b] += [end] + ([a] if most is None else [])
            self.add(inner, a, b)


def parse(pattern: str):
    """Literals, escapes, ``.``, classes, groups, ``|`` and ``* + ? {n,}``."""
    node, rest = _alternatives(pattern)
    if rest:
        raise ValueError(f"cannot read {rest!r} in {pattern!r}")
    return node


def _alternatives(rest: str):
    options = []
    while True:
        parts = []
        while rest and rest[0] not in "|)":
            atom, rest = _atom(rest)
            while rest and rest[0] in "*+?{":
                if rest[0] == "{":
                    bound, _, rest = rest[1:].partition("}")
                    low, comma, high = bound.partition(",")
                    if not comma or high:
                        raise ValueError("only {n,} is read")
                    atom = ("repeat", atom, int(low), None)
                else:
                    atom = ("repeat", atom, int(rest[0] == "+"), 1 if rest[0] == "?" else None)
                    rest = rest[1:]
            parts.append(atom)
        options.append(("seq", parts))
        if not rest.startswith("|"):
            return (options[0] if len(options) == 1 else ("or", options)), rest
        rest = rest[1:]


def _atom(rest: str):
    first = rest[0]
    if first == "(":
        node, rest = _alternatives(rest[1:])
        if not rest.startswith(")"):
            raise ValueError("unclosed group")
        return node, rest[1:]
    if first == "[":
        end = rest.index("]", 2)
        return ("set", _class(rest[1:end])), rest[end + 1:]
    if first == ".":
        return ("set", frozenset(range(256))), rest[1:]
    if first == "\\":
        return ("set", frozenset(rest[1].encode())), rest[2:]
    return ("seq", [("set", frozenset([b])) for b in first.encode()]), rest[1:]


def _class(body: str) -> frozenset[int]:
    negated, body = body.startswith("^"), body.removeprefix("^")
    found, i = set(), 0
    while i < len(body):
        if i + 2 < len(body) and body[i + 1] == "-":
            found.update(range(ord(body[i]), ord(body[i + 2]) + 1))
            i += 3
        else:
            found.add(ord(body[i]))
            i += 1
    if max(found, default=0) > 127:
        raise ValueError("classes are of ASCII characters")
    return frozenset(range(256)) - found if negated else frozenset(found)


def _turned(node):
    """The node that reads the same texts backwards."""
    kind = node[0]
    if kind == "seq":
        return ("seq", [_turned(x) for x in reversed(node[1])])
    if kind == "or":
        return ("or", [_turned(x) for x in node[1]])
    if kind == "repeat":
        return ("repeat", _turned(node[1]), node[2], node[3])
    return node


# --- NFA to minimal DFA -----------------------------------------------------


@dataclass(frozen=True)
class Dfa:
    """``step[256 * state + byte]`` is 256 * next; ``marks[state]`` is the bit
    set of rules that end there; ``dead`` is the state that leads nowhere."""

    step: list[int]
    marks: list[int]
    start: int
    dead: int


def compile_dfa(nodes: Sequence, anywhere: bool) -> Dfa:
    """One automaton for all ``nodes``; ``anywhere`` lets a match begin at any
    byte, so that the marks tell where matches end."""
    nfa = Nfa()
    start, ends = nfa.state(), {}
    if anywhere:
        nfa.step[start].append((frozenset(range(256)), start))
    for k, node in enumerate(nodes):
        a, b = nfa.state(), nfa.state()
        nfa.free[start].append(a)
        nfa.add(node, a, b)
        ends[b] = 1 << k

    def closed(states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in nfa.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)

    # Bytes that no rule tells apart move together.
    kinds: dict[tuple, list[int]] = {}
    sets = list({x for steps in nfa.step for x, _ in steps})
    for b in range(256):
        kinds.setdefault(tuple(b in x for x in sets), []).append(b)
    groups = list(kinds.values())

    names = {closed([start]): 0}
    todo, rows, marks = [closed([start])], [], []
    while todo:
        subset = todo.pop(0)
        marks.append(sum(ends.get(s, 0) for s in subset))
        row = []
        for group in groups:
            after = closed({n for s in subset for x, n in nfa.step[s] if group[0] in x})
            if after not in names:
                names[after] = len(names)
                todo.append(after)
            row.append(names[after])
        rows.append(row)

    # Partition refinement: split classes until all members step alike.
    order = {m: i for i, m in enumerate(sorted(set(marks)))}
    part = [order[m] for m in marks]
    while True:
        seen: dict[tuple, int] = {}
        finer = [seen.setdefault((part[s], *(part[n] for n in rows[s])), len(seen)) for s in range(len(rows))]
        if len(seen) == len(set(part)):
            break
        part = finer
    number: dict[int, int] = {}
    for p in part:
        number.setdefault(p, len(number))
    size = len(number)
    step, mark = [0] * (256 * size), [0] * size
    for s, row in enumerate(rows):
        at = number[part[s]]
        mark[at] = marks[s]
        for group, n in zip(groups, row):
            for b in group:
                step[256 * at + b] = 256 * number[part[n]]
    dead = next((s for s in range(size) if not mark[s] and all(x == 256 * s for x in step[256 * s:256 * s + 256])), -1)
    return Dfa(step, mark, 256 * number[part[0]], 256 * dead)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    joined: Dfa
    hits: frozenset[int]
    forward: tuple[Dfa, ...]
    backward: tuple[Dfa, ...]
    head: tuple[Dfa, ...]


@lru_cache(maxsize=8)
def build_scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    whole = []
    for r in rules:
        # A plain run that must be long is only reported once it is.
        least = r.least if not r.head and r.body.endswith("+") else 0
        whole.append(parse(r.head + (r.body[:-1] + f"{{{least},}}" if least else r.body)))
    joined = compile_dfa(whole, anywhere=True)
    return Scanner(
        rules, joined, frozenset(256 * s for s, m in enumerate(joined.marks) if m),
        tuple(compile_dfa([x], False) for x in whole), tuple(compile_dfa([_turned(x)], False) for x in whole),
        tuple(compile_dfa([parse(r.head)], False) for r in rules),
    )


def _longest(dfa: Dfa, data: bytes, at: int, stop: int, way: int) -> int:
    """The last place from ``at`` on, going ``way``, where the automaton accepts; -1 if none."""
    state, step, marks, dead, found = dfa.start, dfa.step, dfa.marks, dfa.dead, -1
    while True:
        if marks[state >> 8]:
            found = at
        if at == stop:
            return found
        state = step[state + data[at if way > 0 else at - 1]]
        if state == dead:
            return found
        at += way


def scan(data: bytes, scanner: Scanner) -> list[tuple[int, int, int]]:
    """(start, rule number, end) in bytes, by start, then rule."""
    step, hits, state = scanner.joined.step, scanner.hits, scanner.joined.start
    ends: list[tuple[int, int]] = []
    at = 0
    for byte in data:
        state = step[state + byte]
        at += 1
        if state in hits:
            ends.append((at, state))
    found, free = [], [0] * len(scanner.rules)
    for at, state in ends:
        mark = scanner.joined.marks[state >> 8]
        for k, rule in enumerate(scanner.rules):
            if mark >> k & 1 and at > free[k]:
                start = _longest(scanner.backward[k], data, at, free[k], -1)
                if start < 0:
                    continue  # it would begin inside the last match
                end = _longest(scanner.forward[k], data, start, len(data), 1)
                free[k] = end
                body = end - _longest(scanner.head[k], data, start, end, 1) if rule.least_body else 0
                if end - start >= rule.least and body >= rule.least_body:
                    found.append((start, k, end))
    return sorted(found)


def _in_code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or data.isascii():
        return spans
    place, known, count = {}, 0, 0
    for at in sorted({x for s, _, e in spans for x in (s, e)}):
        count += len(data[known:at].decode("utf-8", "replace"))
        place[at], known = count, at
    return [(place[s], k, place[e]) for s, k, e in spans]


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans``: array of kind, start and end, by start."""
    kind = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("spans", T.ArrayType(kind))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = build_scanner(rules)
        names = [r.kind for r in rules]
        for batch in batches:
            spans = [
                [{"kind": names[k], "start": s, "end": e} for s, k, e in _in_code_points(data, scan(data, scanner))]
                for data in bytes_of(batch.column(1))
            ]
            of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, of)], names=["doc_id", "spans"])

    return map_batches(rows, work, schema)
