"""Token counts through a digest cache (operator 10).

The cache is a table of content digest, tokenizer digest and count in a shared
folder. Documents are reduced to digests of their normalised content, looked up
in the cache, and only one text of each missing digest is encoded; the new
counts are appended to the cache, and all documents read their counts from it.

Normalised content is the text after the tokenizer's own normaliser, so texts
that it cannot tell apart share an entry. The tokenizer digest covers its file
and the library's version, so a changed tokenizer never meets old counts.

Inside a task, texts are cut where a single space stands between two characters
that are not white space. There a byte-level tokenizer with this pattern always
begins a new piece, so the count of a text is the sum over its parts, and equal
parts are encoded once. Texts with other white space next to a space, or with a
special token in them, go to the library whole, as do all texts for tokenizers
of another kind.

Defined cases: a null text is empty and has no tokens; repeated rows share one
entry; null and repeated ids are kept as they are; an empty table gives no
rows; other columns are ignored. A very common text is looked up by a join that
adaptive execution splits; its text itself is sent once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmill.llm.common import exists, map_batches, stage, texts_of

#: Entries of a task's memory of parts.
MEMORY = 300_000
#: White space that a text may hold besides the space and the line break.
OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_BESIDE = re.compile(r"\s | \s")


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + b"\0" + tokenizers.__version__.encode()).hexdigest()


class Counter:
    """Counts tokens as the library does, without begin, end or added tokens."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (
            spec.get("normalizer") is None and spec["model"].get("type") == "BPE"
            and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        )
        self.special = [x["content"] for x in spec.get("added_tokens") or []]
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> list[int]:
        found = []
        for i in range(0, len(texts), 10_000):
            found += [len(x) for x in self.library.encode_batch_fast(texts[i:i + 10_000], add_special_tokens=False)]
        return found

    def _whole(self, text: str) -> bool:
        if not self.cuts or "  " in text or " \n" in text or "\n " in text or any(x in text for x in self.special):
            return True
        return any(c in text for c in OTHER_SPACE) and _BESIDE.search(text) is not None

    def count(self, texts: list[str]) -> list[int]:
        whole = [i for i, t in enumerate(texts) if self._whole(t)]
        counts = dict(zip(whole, self._encode([texts[i] for i in whole])))
        cut = {i: t.split(" ") for i, t in enumerate(texts) if i not in counts}
        heads, parts = set(), set()
        for p in cut.values():
            heads.add(p.pop(0))
            parts.update(p)
        if len(self.later) + len(self.first) > MEMORY:
            self.first, self.later = {}, {}
        new = [x for x in heads if x not in self.first]
        self.first.update(zip(new, self._encode(new)))
        new = [x for x in parts if x not in self.later]
        self.later.update(zip(new, self._encode([" " + x for x in new])))
        get = self.later.__getitem__
        for i, p in cut.items():
            head = texts[i].partition(" ")[0]
            counts[i] = self.first[head] + sum(map(get, p))
        return [counts[i] for i in range(len(texts))]


@lru_cache(maxsize=2)
def counter_of(path: str) -> Counter:
    """Kept by a Python worker from task to task."""
    return Counter(path)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` per row.

    ``tokenizer`` is a file that every executor can read, ``cache`` a shared
    folder that this call creates or extends.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    plain = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    content = _normalised(plain, tokenizer)
    digest = F.sha2("content", 256)
    # One row of a digest is its owner, named by id and digest: the id alone may repeat or be null.
    owner = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest")
    keys = stage(content.select("doc_id", "n_bytes", digest.alias("digest")), "digests")
    missing = keys.join(_read(spark, cache, version), "digest", "left_anti") if exists(spark, cache) else keys
    owners = missing.groupBy("digest").agg(F.min(owner).alias("owner")).select("owner")
    texts = content.select("content", digest.alias("digest"), "doc_id").select("content", "digest", owner.alias("owner"))
    texts = texts.join(owners, "owner", "left_semi").select("digest", "content")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = counter_of(tokenizer), set()
        for batch in batches:
            # Rows that repeat with their id arrive in one task.
            new = {d: t for d, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))) if d not in seen}
            seen.update(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(new), pa.string()), pa.array([version] * len(new), pa.string()),
                 pa.array(counter.count(list(new.values())), pa.int64())],
                names=["content_digest", "tokenizer_digest", "n_tokens"],
            )

    counted = map_batches(texts, work, T.StructType([
        T.StructField("content_digest", T.StringType()), T.StructField("tokenizer_digest", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]))
    counted.write.mode("append").parquet(cache)
    return keys.join(_read(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _read(spark, cache: str, version: str) -> DataFrame:
    """Counts of one tokenizer; entries that two runs added are the same."""
    rows = spark.read.parquet(cache).where(F.col("tokenizer_digest") == version)
    return rows.groupBy(F.col("content_digest").alias("digest")).agg(F.max("n_tokens").alias("n_tokens"))


def _normalised(plain: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` of the text, and ``content`` after the normaliser."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = json.load(file)
    size = F.octet_length("text").cast("long").alias("n_bytes")
    if spec.get("normalizer") is None:
        return plain.select("doc_id", size, F.col("text").alias("content"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        normalise = Tokenizer.from_file(tokenizer).normalizer.normalize_str
        for batch in batches:
            column = pa.array([normalise(t) for t in texts_of(batch.column(2))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], names=["doc_id", "n_bytes", "content"])

    rows = plain.select("doc_id", size, "text")
    return map_batches(rows, work, T.StructType([
        T.StructField("doc_id", plain.schema["doc_id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("content", T.StringType())]))
