"""Token alignment against all pairs of tokens of each text."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelmill.llm import tokenalign
from tests.llm.fixtures import awkward, frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spans(texts):
    """(id, first byte, end) of all tokens by both libraries, none if the bytes differ."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    found = []
    for text in texts:
        sides = []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids
            sides.append([(i, bytes(code[c] for c in a.id_to_token(i))) for i in ids])
            sides.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                          for i in b.encode(text)])
        if not text or any(b"".join(x for _, x in s) != (" " + text).encode() for s in sides):
            found.append(([], []))
            continue
        told = []
        for side in sides:
            at, row = 0, []
            for i, x in side:
                row.append((i, at, at + len(x)))
                at += len(x)
            told.append(row)
        found.append(tuple(told))
    return found


def brute(texts):
    all_spans = spans(texts)
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in all_spans]
    counts = Counter(p for row in links for p in row)
    best = defaultdict(int)
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = []
    for (a, b), row in zip(all_spans, links):
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, _, e in side if start < e <= end) for side in (a, b)))
            start = end
        rows.append((len(a), len(b), len(ends), len(row), sum(counts[p] == best[p[1]] for p in row), sum(counts[p] for p in row),
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return rows


TEXTS = ["", None, "the", "a▁b", "<|endoftext|> and </s> <s>", "naïve Ünïcode 🙂🙂 über", "x  y\n\n z\t", "\x00 nul", " lead", "日本語のテキスト",
         "a" * 500, "The theatre then them", "1234567 3.14", "<0x41>"]


def test_all_columns_equal_all_pairs(spark):
    # One text holds a third of the rows; ids are null or repeat.
    texts = TEXTS + ["the same text again"] * 12 + [t for _, t in awkward() if t is None or len(t) < 3000]
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    want = sorted(zip(map(str, ids), brute(texts)))
    got = tokenalign.align_counts(frame(spark, list(zip(ids, texts))), A, B).collect()
    assert sorted((str(r[0]), tuple(r)[1:]) for r in got) == want


def test_small_batches_share_counts(spark):
    texts = [f"word {i % 5} the theatre" for i in range(60)]
    docs = frame(spark, list(enumerate(texts))).repartition(7)
    got = {r[0]: tuple(r)[1:] for r in tokenalign.align_counts(docs, A, B).collect()}
    assert [got[i] for i in range(60)] == brute(texts)


def test_long_text_and_empty_table(spark):
    text = awkward()[10][1]
    got = tokenalign.align_counts(frame(spark, [(1, text)]), A, B).first()
    assert got.n_links == got.n_a + got.n_b - got.n_groups > 100_000
    assert tokenalign.align_counts(frame(spark, [(1, "x")]).where("false"), A, B).collect() == []


def test_align_gives_groups(spark):
    row = tokenalign.align(frame(spark, [(1, "theatre then")]), A, B).first()
    assert row.a_cuts[-1] == len(row.a_ids) and row.b_cuts[-1] == len(row.b_ids) and len(row.a_cuts) == len(row.b_cuts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30))
def test_links_are_all_overlaps(a, b):
    # Bring both to the same length.
    gap = sum(a) - sum(b)
    a, b = a + [1] * max(0, -gap), b + [1] * max(0, gap)

    class Sizes:
        a_sizes, b_sizes = [0, *a], [0, *b]

    codes, groups = tokenalign.align_ids(list(range(1, len(a) + 1)), list(range(1, len(b) + 1)), Sizes)
    ends = lambda x: [(sum(x[:i]), sum(x[:i + 1])) for i in range(len(x))]
    want = {(i + 1, j + 1) for i, p in enumerate(ends(a)) for j, q in enumerate(ends(b)) if p[0] < q[1] and q[0] < p[1]}
    assert len(codes) == len(want) and {(c >> 32, c & (1 << 32) - 1) for c in codes} == want
    assert len(groups) == len({e for _, e in ends(a)} & {e for _, e in ends(b)})
