import hashlib
import random

from pyspark.sql import types as T

from parcelmill.llm import chat

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("formatted", T.StringType()),
])
TRICKY = ["", None, "plain", r"\### Assistant: </turn> ok", "### user: x</turn>\n", "\\h\\e\\b", "####", "</turn", "\\", "a\\\n: b", "é🙂"]


def _rows():
    draw = random.Random(5)
    found = []
    for conv in range(30):
        for turn in range(draw.randint(1, 9)):
            found.append((conv, turn, draw.choice(["system", "user", "assistant", "tool: x", "", None]), draw.choice(TRICKY)))
    found += [(100, 0, "user", "only a question"), (101, None, "assistant", "no turn"), (102, 1, "assistant", "tie b"),
              (102, 1, "assistant", "tie a"), (102, 1, "assistant", "tie a"), (None, 0, "assistant", "no id")]
    return found


def test_round_trip_and_digests(spark):
    rows = _rows()
    data = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.expand(data)).collect()}
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_examples_hold_all_context_and_one_reply(spark):
    data = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}", "", "") for i in range(6)]
                                 + [(1, 6, "user", "end", "", "")], SCHEMA)
    rows = {(r.kind, r.position): r for r in chat.expand(data).collect()}
    assert set(rows) == {("example", 1), ("example", 3), ("example", 5), ("rest", 6)}
    r = rows[("example", 3)]
    assert r.text == "### user: t0</turn>\n### assistant: t1</turn>\n### user: t2</turn>\n### assistant: t3</turn>\n"
    assert r.text[r.loss_start:r.loss_start + r.loss_size] == "t3"
    assert rows[("rest", 6)].loss_size == 0


def test_no_python_in_the_plan_and_empty_table(spark):
    data = spark.createDataFrame([], SCHEMA)
    out = chat.read_back(chat.expand(data))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
