"""Line dedup: lines that stand in many documents go from all of them.

Lines are brought to a normal form and hashed; a hash is counted once for each document that has it; lines whose count
reaches the threshold are found again by their hash, and each text is put together from its other lines by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.llm.common import keep_table, read

BLANKS = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCUMENTS = 10
# At most so many keys hold each at least one of so many parts of all (document, line) pairs: these are broadcast.
HOT_PARTS = 20_000


def normal_lines(text: Column) -> Column:
    """The keys of a text's lines: A-Z lower-cased, ASCII blanks stripped at both ends."""
    # lower() knows all of Unicode; it agrees where every character is one byte
    lowered = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(lowered, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))


def _hashes(key: str) -> list[Column]:
    """128 bits of a key, as two numbers: with 64 alone, some of 10^12 lines would share one."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), F.col(key)).alias("h2")]


def document_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(h1, h2, n): in how many rows the key occurs. Each row's keys are made distinct within the row, so one shuffle of
    sums by hash, combined map-side, counts them; a line of all documents sends one row a task."""
    keys = F.filter(F.array_distinct(normal_lines(F.col(text_col))), lambda k: k != "")
    return texts.select(F.explode(keys).alias("key")).select(*_hashes("key")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))


def _marked(lines: DataFrame, frequent: DataFrame, pairs: int) -> DataFrame:
    """The rows of ``lines`` whose hash is in ``frequent``. Keys with a large part of all pairs are few whatever the
    corpus, so they are broadcast and their lines not shuffled; the others meet by a join of evenly filled keys."""
    least = -(-pairs // HOT_PARTS)
    hot, other = (frequent.where(c).select("h1", "h2") for c in (F.col("n") >= least, F.col("n") < least))
    found = lines.join(F.broadcast(hot), ["h1", "h2"], "left_semi")
    return found.unionByName(lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti").join(other, ["h1", "h2"], "left_semi"))


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the ascending positions in ``dropped``, in time proportional to their number."""
    count = F.size(dropped)

    def flags(k: Column) -> Column:
        before = F.when(k == 0, -1).otherwise(F.get(dropped, k - 1))
        here = F.when(k == count, F.size(lines)).otherwise(F.get(dropped, k))
        gap = F.array_repeat(F.lit(False), (here - before - 1).cast("int"))
        return F.when(k == count, gap).otherwise(F.concat(gap, F.array(F.lit(True))))

    marks = F.flatten(F.transform(F.sequence(F.lit(0), count), flags))
    kept = F.filter(F.arrays_zip(lines.alias("line"), marks.alias("gone")), lambda x: ~x["gone"])
    return F.transform(kept, lambda x: x["line"])


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(id, text, n_lines, n_dropped) per row of ``docs``: its text without the lines that ``least_documents`` rows share.

    Every row is a document of its own: repeated rows and ids count each, null ids too. A null or empty text is one empty
    line, its result an empty text; lines without anything but blanks are never dropped, nor do they count. A line that a
    text repeats counts once. Ties do not occur. Other columns of ``docs`` are ignored, whatever their names; an empty
    table gives an empty result. A row's lines must fit a task, as the row itself does; nothing else grows with the input
    in one task.
    """
    rows = keep_table(docs.select(
        F.col(id_col).alias("id_"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text_"),
        F.monotonically_increasing_id().alias("row_")), "line-rows")
    counted = document_counts(rows, "text_").where(F.col("n") >= least_documents)
    frequent = keep_table(counted, "frequent-lines")
    pairs = frequent.agg(F.sum("n")).first()[0] or 0
    lines = rows.select("row_", F.posexplode(normal_lines(F.col("text_"))).alias("at", "key")).where("key <> ''")
    marked = _marked(lines.select("row_", "at", *_hashes("key")), frequent, max(pairs, 1))
    gone = marked.groupBy("row_").agg(F.sort_array(F.collect_list("at")).alias("gone_"))
    # the list grows with the corpus, so it is merged with the texts at every size and never broadcast
    joined = rows.join(gone.hint("merge"), "row_", "left").select(
        "id_", "text_", F.split("text_", "\n").alias("lines_"), "gone_")
    return joined.select(
        F.col("id_").alias(id_col),
        F.when(F.col("gone_").isNull(), F.col("text_"))
        .otherwise(F.array_join(_without(F.col("lines_"), F.col("gone_")), "\n")).alias(text_col),
        F.size("lines_").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone_"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's line counts and the digest of its kept text."""
    kept = drop_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH lines AS (
    SELECT row_id, doc_id, unnest(cut) AS line, generate_subscripts(cut, 1) AS place
    FROM (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS cut FROM documents)
), keyed AS (
    SELECT *, trim(translate(line, '{UPPER}', '{LOWER}'), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS key
    FROM lines
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= {LEAST_DOCUMENTS}
), marked AS (
    SELECT row_id, doc_id, line, place, key IN (SELECT key FROM frequent) AS gone FROM keyed
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY row_id
"""
