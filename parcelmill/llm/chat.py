r"""Chat formatting by prefix-target expansion (operator 4, native).

Every assistant turn becomes an example of its own: all turns before it are
the context and only that reply is trainable. The whole path is DataFrame
functions.

Template, one turn after the other::

    ### <role>: <text></turn>\n

Control strings inside roles and texts are escaped, so that a parser never
takes them for marks and the original comes back exactly: ``\`` becomes
``\b``, ``###`` becomes ``\h``, ``</turn>`` becomes ``\e`` and, in roles, ``:``
becomes ``\c``. A backslash in escaped text always begins one of these codes,
so undoing them one after the other, ``\b`` last, is unambiguous.

Defined cases: a null text or role is empty; turns are ordered by turn, then
role, then text, a null turn first, so repeated turns are kept and ties are
stable; rows with a null ``conv_id`` form one conversation; turns after the
last reply, or a conversation without one, give a row ``kind = 'rest'`` with
nothing to train on, so no turn is lost. Columns other than the four are
ignored. A conversation is one string, as each example must be; the examples of
one conversation are made where its row lies, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, TAIL = "### ", "</turn>\n"
REPLY = "assistant"


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for code, plain in (("\\h", "###"), ("\\e", "</turn>"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def conversations_as_text(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, and ``turns`` with
    each turn's ``end`` and the ``start`` and ``size`` of its text, in code
    points of ``formatted``."""
    turn = F.struct(
        F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("ordered"))
    lines = ordered.select(
        "conv_id",
        F.transform("ordered", lambda t: F.struct(
            t["role"].alias("role"),
            F.concat(F.lit(HEAD), _escape_role(t["role"]), F.lit(": ")).alias("head"),
            escape(t["text"]).alias("body"),
        )).alias("lines"),
    )
    size = lambda x: F.length(x["head"]) + F.length(x["body"]) + len(TAIL)
    no_turns = F.slice(F.array(F.struct(
        F.lit("").alias("role"), F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0).alias("end"))), 1, 0)
    return lines.select(
        "conv_id",
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"], F.lit(TAIL))), "").alias("formatted"),
        F.aggregate(
            "lines",
            F.struct(F.lit(0).alias("at"), no_turns.alias("turns")),
            lambda state, x: F.struct(
                (state["at"] + size(x)).alias("at"),
                F.concat(state["turns"], F.array(F.struct(
                    x["role"].alias("role"), (state["at"] + F.length(x["head"])).alias("start"),
                    F.length(x["body"]).alias("size"), (state["at"] + size(x)).alias("end"),
                ))).alias("turns"),
            ),
            lambda state: state["turns"],
        ).alias("turns"),
    )


def expand(rows: DataFrame, reply: str = REPLY) -> DataFrame:
    """Training examples of ``rows`` (conv_id, turn, role, text).

    Returns ``conv_id``, ``kind`` ('example' or 'rest'), ``position`` (of the
    reply among the turns; of the first turn of the rest), ``text``, and the
    trainable span ``loss_start``, ``loss_size`` in code points of ``text``.
    """
    whole = conversations_as_text(rows)
    at = F.transform("turns", lambda t, i: F.struct(i.alias("i"), t["role"].alias("role"), t["start"].alias("start"),
                                                    t["size"].alias("size"), t["end"].alias("end")))
    replies = F.filter(at, lambda t: t["role"] == F.lit(reply))
    last = F.when(F.size("replies") > 0, F.element_at("replies", -1))
    whole = whole.withColumn("replies", replies)
    whole = whole.withColumn("done", F.coalesce(last["end"], F.lit(0))).withColumn(
        "next", F.coalesce(last["i"] + 1, F.lit(0)))
    example = F.transform("replies", lambda t: F.struct(
        F.lit("example").alias("kind"), t["i"].alias("position"), F.lit(0).alias("begin"), t["end"].alias("length"),
        t["start"].alias("loss_start"), t["size"].alias("loss_size"),
    ))
    rest = F.when(
        F.col("next") < F.size("turns"),
        F.array(F.struct(
            F.lit("rest").alias("kind"), F.col("next").alias("position"), F.col("done").alias("begin"),
            (F.length("formatted") - F.col("done")).alias("length"),
            F.lit(0).alias("loss_start"), F.lit(0).alias("loss_size"),
        )),
    ).otherwise(F.slice(example, 1, 0))
    cut = whole.select("conv_id", "formatted", F.explode(F.concat(example, rest)).alias("x"))
    return cut.select(
        "conv_id", F.col("x.kind").alias("kind"), F.col("x.position").alias("position"),
        F.substring("formatted", F.col("x.begin") + 1, F.col("x.length")).alias("text"),
        F.col("x.loss_start").alias("loss_start"), F.col("x.loss_size").alias("loss_size"),
    )


def parse(text: Column) -> Column:
    """Turns (role, text) of a formatted text."""
    pieces = F.filter(F.split(text, TAIL, -1), lambda x: x != "")
    return F.transform(pieces, lambda x: F.struct(
        _unescape_role(F.substring(F.substring_index(x, ": ", 1), len(HEAD) + 1, 2**31 - 1)).alias("role"),
        unescape(F.substring(x, F.length(F.substring_index(x, ": ", 1)) + 3, 2**31 - 1)).alias("text"),
    ))


def read_back(examples: DataFrame) -> DataFrame:
    """Digest of each conversation, taken from its examples alone: the last
    example and the rest hold all turns, the loss spans hold the replies."""
    done = F.col("kind") == "example"
    whole = examples.groupBy("conv_id").agg(
        F.coalesce(F.max_by(F.when(done, F.col("text")), F.when(done, F.col("position"))), F.lit("")).alias("told"),
        F.coalesce(F.max(F.when(~done, F.col("text"))), F.lit("")).alias("rest"),
        F.sort_array(F.collect_list(F.when(done, F.struct(
            "position", F.substring("text", F.col("loss_start") + 1, F.col("loss_size")).alias("part"))))).alias("parts"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    turns = parse(F.concat("told", "rest"))
    loss = F.array_join(F.transform("parts", lambda p: unescape(p["part"])), "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted_chars").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
