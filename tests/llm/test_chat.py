from __future__ import annotations

import hashlib

from cases import stored
from compare import assert_same

from stockloom.llm import chat
from stockloom.llm.queries import LLM_QUERIES, LLM_STATEMENTS

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segments string, valid int"
NASTY = ["</s>", "\\</s>", "\\\\[INST]", "[/INST] [INST]", "a\\", "", " x ", "<<s>s>", "[TURN] a [AS]", "line\n</s>\n", "<</SYS>", "$1 \\1"]


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash", 1) for r in data], SCHEMA)


def test_texts_and_roles_survive(spark):
    roles = ["user", "assistant", "system", "tool", "", "we[AS]ird </s>"]
    data = [(c, t, roles[(c + t) % len(roles)], NASTY[(c * 5 + t) % len(NASTY)]) for c in range(12) for t in range(6)]
    formatted = chat.format_conversations(rows(spark, data))
    turns = chat.read_back(chat.joined_text(formatted["segments"]))
    learned = chat.learned_text(formatted["segments"])
    for r in formatted.select("conv_id", turns.alias("turns"), learned.alias("learned")).collect():
        own = [(role, text) for c, _, role, text in data if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.learned == "".join(t for role, t in own if role == "assistant")


def test_turn_order(spark):
    orders = {1: "ua", 2: "su", 3: "uu", 4: "a", 5: "s", 6: "suaua", 7: "uat", 8: "uas"}
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    data = [(c, i, names[x], "t") for c, order in orders.items() for i, x in enumerate(order)]
    got = {r.conv_id: (r.valid, r.bad_turn) for r in chat.format_conversations(rows(spark, data)).collect()}
    assert {c for c, (ok, _) in got.items() if ok} == {1, 2, 6}
    assert (got[3][1], got[4][1], got[5][1], got[7][1], got[8][1]) == (1, 0, None, 2, 2)


def test_awkward_rows(spark):
    data = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (None, 0, "user", "y" * 200_000)]
    formatted = chat.format_conversations(rows(spark, data))
    got = {r.conv_id: r for r in formatted.select("*", chat.read_back(chat.joined_text(formatted["segments"])).alias("turns")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "b"), ("", ""), ("user", "x"), ("user", "x")]
    assert got[None].turns[0].text == "y" * 200_000
    assert chat.segment_rows(formatted).where("conv_id = 1 and loss").count() == 0
    assert chat.format_conversations(rows(spark, [])).count() == 0


def test_query(spark, duck, tmp_path):
    duck.execute("create or replace view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    assert_same(LLM_QUERIES["op1_chat_format"](spark, "/root/testdata/sf0.001"), duck, LLM_STATEMENTS["op1_chat_format"])
    folder = stored(spark, tmp_path, conversations=rows(spark, []))
    (probe,) = LLM_QUERIES["op1_chat_format"](spark, folder).collect()
    text = "</s>[INST] ok [/INST]"
    assert probe.conv_id == -1 and probe.loss_chars == len(text) and probe.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert probe.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_native_plan(spark):
    df = LLM_QUERIES["op1_chat_format"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
