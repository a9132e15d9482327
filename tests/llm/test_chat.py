"""Chat formatting: SQL parity and the exact round trip."""

import hashlib

import parity
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import SMALL, shipped  # noqa: F401

from viewlake.llm import chat
from viewlake.llm.queries import ORACLES, QUERIES


def test_query_equals_sql(spark):
    con = parity.connect(SMALL)
    name = "op4_chat_formatting"
    assert parity.difference(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


pieces = st.sampled_from(["\\", "#", "##", "### ", ": ", "</turn>", "\n", "a", "é🙂", "/", "<", "user"])
texts = st.lists(pieces, max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(texts | st.just("assistant"), texts), min_size=1, max_size=5))
def test_any_turns_come_back(turns):
    roles, bodies = zip(*turns)
    conv, n, formatted, starts, ends = chat.assemble(pa.array([1] * len(turns)), pa.array(roles), pa.array(bodies))
    text = formatted[0].as_py()
    assert n.to_pylist() == [len(turns)] and chat.parse_turns(text) == list(turns)
    learned = [chat.unescape(text[a:b]) for a, b in zip(starts[0].as_py(), ends[0].as_py())]
    assert learned == [t for r, t in turns if r == "assistant"]
    assert text.count("</turn>") == len(turns)


def test_parts_nulls_and_repeats(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} " * 50) for i in range(200)]
    rows += [(2, None, "user", "first"), (2, 0, None, None), (2, 0, "user", "same"), (2, 0, "user", "same"), (None, 0, "assistant", "x"), (3, 1, "user", "y" * 200_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, part string")
    parts = chat.format_conversations(df, task_bytes=10_000)
    assert parts.where("conv_id = 1").count() > 1
    got = {r["conv_id"]: r for r in chat.read_back(parts).collect()}
    assert {c: r["n_turns"] for c, r in got.items()} == {1: 200, 2: 4, None: 1, 3: 1}
    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:200]).encode()).hexdigest()
    assert got[1]["turns_sha256"] == digest
    assert got[1]["loss_chars"] == sum(len(t) for _, _, r, t in rows[:200] if r == "assistant")
    same = "".join(f"{r}\n{t}\n" for r, t in [("user", "first"), ("", ""), ("user", "same"), ("user", "same")])
    assert got[2]["turns_sha256"] == hashlib.sha256(same.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0
