import hashlib
import re

from cases import LONG, SMALL, none, odd, table
from inkwell.llm import line_dedup
from inkwell.llm.queries import QUERIES

BLANKS = " \t\n\v\f\r"


def normal(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))


def plain(texts, least):
    """(kept text, lines, dropped) per text by counting in a dictionary."""
    cut = [(t or "").split("\n") for t in texts]
    counts = {}
    for lines in cut:
        for key in set(map(normal, lines)):
            counts[key] = counts.get(key, 0) + 1
    often = {k for k, n in counts.items() if k and n >= least}
    out = []
    for lines in cut:
        kept = [line for line in lines if normal(line) not in often]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def dropped(spark, texts, least):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in line_dedup.drop_repeated_lines(df, least_documents=least).orderBy("doc_id").collect()]


def test_query_against_plain_python(spark):
    docs = table("documents")
    want = {d["doc_id"]: w for d, w in zip(docs, plain([d["text"] for d in docs], 10))}
    rows = QUERIES["op12_line_dedup"](spark, SMALL).collect()
    assert len(rows) == len(docs) and sum(r["n_dropped"] for r in rows)
    for r in rows:
        text, lines, gone = want[r["doc_id"]]
        assert (r["n_lines"], r["n_dropped"], r["kept_sha256"]) == (lines, gone, hashlib.sha256(text.encode()).hexdigest())


TEXTS = ["a\n B\nc", "b \na\nd\n", "\tB\v\n\n\nb\nÉ", "é\nx", "É", None, "", "\n", "b\nb\nb", "last\nb"]


def test_lines_by_position(spark):
    for least in (1, 2, 3, 100):
        assert dropped(spark, TEXTS, least) == plain(TEXTS, least)


def test_only_ascii_is_lower_cased(spark):
    assert dropped(spark, ["É", "É", "é", "İ", "i"], 2) == [("", 1, 1), ("", 1, 1), ("é", 1, 0), ("İ", 1, 0), ("i", 1, 0)]


def test_a_line_repeated_in_one_document_counts_once(spark):
    assert dropped(spark, ["x\nx\nx", "y"], 2) == [("x\nx\nx", 3, 0), ("y", 1, 0)]


def test_with_and_without_broadcast_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_PARTS", 2)  # only the line of most documents is hot
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert dropped(spark, TEXTS, 2) == plain(TEXTS, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_many_lines_in_one_text(spark):
    text = "\n".join(f"own {i}\nshared" for i in range(100_000))
    got = dropped(spark, [text, "shared"], 2)
    assert got[0][1:] == (200_000, 100_000) and got[0][0].split("\n")[:2] == ["own 0", "own 1"] and got[1] == ("", 1, 1)


def test_odd_rows_and_none(spark):
    df = odd(spark, "row_", "text_", "id_", "gone_", "h1", "n", "key", "at")
    rows = line_dedup.drop_repeated_lines(df, least_documents=2).collect()
    assert len(rows) == 9
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["text"] == by_id[2]["text"] == "" and by_id[1]["n_lines"] == 1
    assert [r["text"] for r in rows if r["doc_id"] == 4] == ["", ""]  # a repeated row is another document
    assert by_id[None]["text"] == "no id here" and by_id[6]["text"] == LONG
    assert by_id[3]["n_lines"] == 2 and by_id[3]["n_dropped"] == 0
    assert line_dedup.drop_repeated_lines(none(spark)).count() == 0


def test_clashing_column_names(spark):
    df = odd(spark).selectExpr("doc_id AS row_", "text AS gone_")
    rows = line_dedup.drop_repeated_lines(df, "row_", "gone_", 2).collect()
    assert sorted(rows[0].asDict()) == ["gone_", "n_dropped", "n_lines", "row_"] and len(rows) == 9
