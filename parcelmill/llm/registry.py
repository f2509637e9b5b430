"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.llm import (
    chat, convtrie, decontam, exactdup, neardup, pieces, quality, secrets, sharding, tokenalign, tokencount, toxicity, urlfilter,
)
from parcelmill.llm.common import held_out, learn_row, stage, table
from parcelmill.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


#: Labels of these ids are held out: crc32 of the id as text, divided, leaves this.
QUALITY_FOLD, TOXIC_FOLD = (3, 1), (5, 0)


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", learn_row("doc_id", *QUALITY_FOLD))
    return quality.score(docs, model).select(
        "doc_id", held_out("doc_id", *QUALITY_FOLD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_shard_bytes")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 16)


#: Two turns full of control strings, formatted beside the table's own.
TRICKY = r"\### Assistant: </turn> ok"

_CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length('### ' || replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), ':', '\c')
      || ': ' || replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') || '</turn>' || chr(10)) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM rows
), running AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY n) AS upto,
    max(CASE WHEN role = 'assistant' THEN n END) OVER (PARTITION BY conv_id) AS last FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) + coalesce(sum(size) FILTER (last IS NULL OR n > last), 0) AS BIGINT)
    AS formatted_chars
FROM running GROUP BY conv_id
"""


@query("op4_chat_examples", _CHAT_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    return chat.read_back(chat.expand(rows.unionByName(tricky)))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", learn_row("doc_id", *TOXIC_FOLD))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", *TOXIC_FOLD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op7_exact_dedup", f"""
WITH plain AS (SELECT doc_id, {_LOWER_SQL} AS plain FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
FROM plain WINDOW w AS (PARTITION BY plain)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(table(spark, sf_dir, "documents"))


_NEAR_SQL = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array({_LOWER_SQL}, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
  d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


@query("op6_near_dedup", _NEAR_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    told = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(told, 256).alias("base_sha256"), told.alias("spans"),
    )


@query("op9_pieces")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pieces.encode_and_decode(docs, model)
    return rows.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # Each call begins with an empty cache, so that it counts all it is given.
    cache = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/token-cache-{uuid.uuid4().hex}"
    return tokencount.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), cache)


#: Conversations are rebuilt in families of this many, see the contract of operator 11.
FAMILY = 20

_CRC32_SQL = """xor(list_reduce([ascii(c) FOR c IN string_split(CAST(conv_id AS VARCHAR), '')], lambda s, b: list_reduce(
    [0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: xor(t >> 1, (t & 1) * 3988292384), xor(s, CAST(b AS BIGINT))), 4294967295::BIGINT), 4294967295::BIGINT)"""

_TRIE_SQL = f"""
WITH rows AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, {_CRC32_SQL} % 4 AS h, s FROM (SELECT conv_id, list(x ORDER BY n) AS s FROM rows GROUP BY conv_id)
), rebuilt AS (
  SELECT o.conv_id, list_concat(CASE WHEN b.s IS NULL THEN [] ELSE b.s[1:o.h] END, o.s[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {FAMILY}
), prefixes AS (
  SELECT conv_id, len(s) AS size, d AS depth, s[1:d] AS p FROM rebuilt, unnest(range(0, len(s) + 1)) AS u(d)
), nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2
), below AS (
  SELECT depth, p, n_convs, conv_id, p[1:depth - 1] AS up,
    len([w FOR w IN regexp_split_to_array(CASE WHEN depth = 0 THEN '' ELSE p[depth].text END, '[\x20\x09-\x0D]+') IF w <> '']) AS words
  FROM nodes
), children AS (SELECT up AS p, count(*) AS n FROM below WHERE depth > 0 GROUP BY 1),
told AS (
  SELECT p[1:d] AS p, sum((n_convs - 1) * words) AS saved, count(*) FILTER (c IS NULL) AS leaves
  FROM (SELECT b.*, c.n AS c FROM below b LEFT JOIN children c USING (p)), unnest(range(0, depth + 1)) AS u(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, t.leaves AS n_leaves,
  CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN told t USING (p) LEFT JOIN children c USING (p) LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.p[1:n.depth - 1]
"""


@query("op11_prefix_trie", _TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = stage(convtrie.sequences(table(spark, sf_dir, "conversations")), "conversations")
    head = F.crc32(F.col("conv_id").cast("string")) % 4
    return convtrie.prefix_nodes(convtrie.rebranched(convs, FAMILY, head)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenalign.align_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


#: Rules of the contract of operator 13: verdict, host, beginning of the path.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


_URL_SQL = r"""
WITH plain AS (
  SELECT page_id, translate(CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://([^/?#]*)', 1, 's') ELSE '' END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path,
    regexp_extract_all(html, '\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s<>]+)', 1, 'i') AS links
  FROM pages
), told AS (
  SELECT *, CASE
    WHEN host = 'example.org' OR suffix(host, '.example.org') THEN CASE WHEN starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN starts_with(path, '/es/') THEN 'example.org/es/' WHEN starts_with(path, '/') THEN 'org/' END
    WHEN host = 'org' OR suffix(host, '.org') THEN CASE WHEN starts_with(path, '/') THEN 'org/' END
    WHEN host = 'com' OR suffix(host, '.com') THEN CASE WHEN starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN starts_with(path, '/de/') THEN 'com/de/' END END AS rule,
    CASE WHEN len(list_filter(links, lambda x: lower(x) <> host)) > 0 THEN error('this check is for pages without links between hosts') END AS none
  FROM plain
), judged AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS fit FROM told
), hosts AS (
  SELECT host, count(*) FILTER (fit = 'allow') / count(*) AS trust, count(*) FILTER (fit = 'block') / count(*) AS distrust
  FROM judged WHERE host <> '' GROUP BY host
)
SELECT page_id, host, path, rule,
  coalesce(fit, CASE WHEN distrust >= 0.5 AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN hosts USING (host) WHERE none IS NULL
"""


@query("op13_url_filter", _URL_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")
