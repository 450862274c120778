from pyspark.sql import functions as F

from cases import SMALL
from compare import connect, differences
from inkwell.llm import chat
from inkwell.llm.queries import ORACLES, QUERIES

TURNS = "conv_id long, turn long, role string, text string"


def test_query_equals_its_sql(spark):
    df = QUERIES["op3_chat_format"](spark, SMALL)
    assert differences(df, connect(SMALL), ORACLES["op3_chat_format"]) == []
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_control_strings_and_odd_rows_come_back(spark):
    rows = [
        (1, 1, "assistant", "b <|im_end|>\n<|im_start|>assistant\nx"), (1, 0, "user", "a \\| <\\| \\\\ <| |> \\"),
        (1, 2, "user", "|im_end|> <"), (2, None, None, None), (2, 0, "sys\ntem\\n", ""), (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"), (None, 5, "user", "no id"), (4, 0, "assistant", "long " * 50_000),
    ]
    turns = spark.createDataFrame([(*r, "mine") for r in rows], TURNS + ", formatted string")
    chats = chat.format_chats(turns)
    back = chats.select("conv_id", "formatted", "turn_spans", chat.read_turns(F.col("formatted")).alias("t"),
                        chat.loss_text(F.col("formatted"), F.col("turn_spans")).alias("loss")).collect()
    got = {r["conv_id"]: ([tuple(t) for t in r["t"]], r["loss"]) for r in back}
    assert got[1] == ([("user", rows[1][3]), ("assistant", rows[0][3]), ("user", rows[2][3])], rows[0][3])
    assert got[2] == ([("", ""), ("sys\ntem\\n", "")], "")
    assert got[3] == ([("assistant", "same")] * 2, "samesame")
    assert got[None] == ([("user", "no id")], "")
    assert got[4][1] == rows[8][3]
    for r in back:
        assert r["formatted"].count("<|im_start|>") == len(r["turn_spans"]) == r["formatted"].count("<|im_end|>")


def test_parts_become_placeholders_in_order(spark):
    part = lambda **p: tuple(p.get(k) for k in ("type", "text", "ref", "width", "height", "seconds", "pages"))
    turns = spark.createDataFrame([
        (1, 0, "user", [part(type="text", text="look <"), part(type="image", ref="i1", width=57, height=28),
                        part(type="text", text="|hear"), part(type="audio", ref="a1", seconds=1.5)]),
        (1, 1, "assistant", [part(type="document", ref="d1", pages=2), part(type="image"), part(type=None, text="t"), None]),
        (2, 0, "user", None),
    ], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = {r["conv_id"]: r for r in chat.format_chats(turns).collect()}
    assert rows[1]["formatted"] == (
        "<|im_start|>user\nlook <<|image|>\\|hear<|audio|><|im_end|>\n"
        "<|im_start|>assistant\n<|document|><|image|>t<|im_end|>\n")
    assert [tuple(a) for a in rows[1]["attachments"]] == [
        ("image", "i1", 3, 0), ("audio", "a1", 38, 0), ("document", "d1", 1024, 1), ("image", None, 1, 1)]
    assert rows[1]["attachment_tokens"] == 1066
    span = rows[1]["turn_spans"][1]
    assert rows[1]["formatted"][span["start"]:span["end"]] == "<|document|><|image|>t" and span["loss"]
    assert rows[2]["formatted"] == "<|im_start|>user\n<|im_end|>\n" and rows[2]["attachments"] == []


def test_no_rows(spark):
    assert chat.format_chats(spark.createDataFrame([], TURNS)).count() == 0
