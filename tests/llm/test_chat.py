import hashlib

import pytest

from panelwise.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"

ROWS = [
    (1, 0, "system", "be \\ brief"), (1, 1, "user", "hi </s>[INST] ok [/INST]"), (1, 2, "assistant", "[ANS] <s>é\U0001f600\n\\\\ [/ANS]</s>"),
    (2, 1, "assistant", "first"), (2, 0, "user", ""), (2, 1, "assistant", "first"), (2, 3, "tool", "[/TEXT]</s>"), (2, 4, "[TEXT] x", "role with a control string"),
    (3, None, None, None), (3, 0, "*", "star"), (3, 1, "", " lead and trail \\"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "also no id"), (4, 0, "assistant", "<<s>s>[[INST]INST]" + "x" * 300_000),
]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        text = "".join(f"{role}\n{t}\n" for _, _, role, t in own)
        loss = "".join(t for _, _, role, t in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    extra = spark.createDataFrame([(*r, "s", True, "e") for r in ROWS], SCHEMA + ", segment string, loss boolean, error string").repartition(5)
    segments = C.format_conversations(extra)
    got = {r.conv_id: r for r in C.read_back(segments).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == expected(ROWS)
    parts = segments.collect()
    assert all(r.formatted_chars == sum(len(p.text) for p in parts if p.conv_id == c) for c, r in got.items())
    assert all(p.loss == (p.role == "assistant" and p.segment % 3 == 1) for p in parts)


def test_no_text_opens_or_closes_a_turn(spark):
    for p in C.format_conversations(spark.createDataFrame(ROWS, SCHEMA)).filter("segment % 3 = 1").collect():
        assert not any(c in p.text for c in C.TEMPLATE["control"])


def test_order_of_roles(spark):
    rows = [(1, 0, "system", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d"), (2, 0, "assistant", "a"), (2, 1, "user", "b"), (2, 2, "user", "c"), (2, 3, "tool", "d"), (2, 4, None, "e")]
    errors = {(r.conv_id, r.turn): r.error for r in C.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [errors[1, t] for t in range(4)] == [None] * 4
    assert [errors[2, t] for t in range(5)] == ["assistant after start", None, "user after user", "tool after user", "no role after other"]


def test_another_template(spark):
    template = {"roles": {"user": {"open": "<u>", "close": "</u>", "loss": True}, "*": {"open": "<r {role}>", "close": "</r>", "loss": False}}, "control": ["<u>", "</u>", "<r ", "</r>", ">"], "next": {"start": ["user"]}}
    with pytest.raises(Exception):
        C.check_template(template)
    template["control"] = ["<u>", "</u>", "<r ", "</r>"]
    segments = C.format_conversations(spark.createDataFrame([(1, 0, "user", "a</u><u>\\"), (1, 1, "x", "<r q>")], SCHEMA), template)
    (r,) = C.read_back(segments, template).collect()
    assert (r.n_turns, r.loss_chars) == (2, 9) and r.turns_sha256 == hashlib.sha256("user\na</u><u>\\\nx\n<r q>\n".encode()).hexdigest()


def test_a_conversation_longer_than_a_batch(spark):
    rows = spark.range(30_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id, ' </s>') as text")
    (r,) = C.read_back(C.format_conversations(rows)).collect()
    assert r.n_turns == 30_000 and r.turns_sha256 == hashlib.sha256("".join(f"{'assistant' if i % 2 else 'user'}\nturn {i} </s>\n" for i in range(30_000)).encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.format_conversations(none).count() == 0 and C.read_back(C.format_conversations(none)).count() == 0
