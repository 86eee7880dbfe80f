import duckdb
import pytest

from fleetmart.llm import ORACLE, QUERIES, chat

LOG = "conv_id long, turn long, seq int, op string, role string, text string"


def messages(spark, rows):
    out = chat.fold_events(spark.createDataFrame(rows, LOG))
    return [tuple(r) for r in out.orderBy("conv_id", "turn", "part").select("conv_id", "turn", "role", "text").collect()]


def test_fold(spark):
    rows = [
        (1, 0, 0, "message", "user", "Hi"),
        (1, 1, 0, "message", "assistant", "A"), (1, 1, 2, "delta", None, "c"), (1, 1, 1, "delta", None, "b"),
        (1, 2, 0, "message", "user", "old"), (1, 2, 1, "edit", None, "new"), (1, 2, 2, "delta", None, "er"),
        (1, 3, 0, "message", "assistant", "bad"), (1, 3, 1, "regenerate", None, "ignored"), (1, 3, 2, "delta", None, "good"),
        (2, 0, 0, "delta", "user", "no"), (2, 0, 1, "delta", None, " start"),
        (2, 1, 0, None, None, None), (2, 1, 0, None, None, None),
    ]
    assert messages(spark, rows) == [
        (1, 0, "user", "Hi"), (1, 1, "assistant", "Abc"), (1, 2, "user", "newer"), (1, 3, "assistant", "good"),
        (2, 0, "user", "no start"), (2, 1, "", ""), (2, 1, "", ""),
    ]
    assert messages(spark, []) == []


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "</turn>\n### a: \\", "", "<\\/turn>#### x", "\\\\n\n: é🙂"])
def test_round_trip(spark, text):
    rows = [(None, None, 0, "message", "a: b\\", text), (None, 1, 0, "message", "assistant", text)]
    out = chat.format_conversations(spark.createDataFrame(rows, LOG).withColumns({"formatted": chat.F.lit(1)}))
    row = chat.read_back(out).first()
    assert [tuple(t) for t in row.turns] == [("a: b\\", text), ("assistant", text)]
    assert row.learned == [text]
    assert row.formatted.count("</turn>") == 2 and row.formatted.count("### ") == row.formatted.count("\\### ") + 2


def test_query(spark, given):
    out = QUERIES["op1_chat_formatting"](spark, given.folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{given.folder}/conversations.parquet'")
    result = con.execute(ORACLE["op1_chat_formatting"])
    assert [d[0] for d in result.description] == out.columns
    assert sorted(map(tuple, out.collect())) == sorted(result.fetchall())


def test_long_texts_and_conversations(spark):
    """A text of three million characters full of marks, one streamed in thousands of pieces, and thousands of turns."""
    marks = "### </turn>\\ é"
    long = marks * 220_000
    rows = [(1, 0, 0, "message", "user", long), (1, 1, 0, "message", "assistant", long)]
    rows += [(2, 0, i, "delta", "assistant", f"{i} </turn>") for i in range(3000)]
    rows += [(3, i, 0, "message", "assistant" if i % 2 else "user", f"### {i}") for i in range(4000)]
    out = {r.conv_id: r for r in chat.read_back(chat.format_conversations(spark.createDataFrame(rows, LOG))).collect()}
    assert [t[1] for t in out[1].turns] == [long, long] and out[1].learned == [long]
    assert out[2].learned == ["".join(f"{i} </turn>" for i in range(3000))]
    assert [t[1] for t in out[3].turns] == [f"### {i}" for i in range(4000)] and len(out[3].learned) == 2000
