"""Quality by weak supervision: rules vote good or bad or abstain, expectation-maximisation estimates how well each
votes, and the posterior probability of good quality decides instead of a filter that all rules must pass."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.llm.common import keep_table, map_arrow, read

SYMBOLS = "#*$%&|<>"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_ended")
KEEP_FROM = 0.85
ROUNDS = 100


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words which is found twice or more, its first place included."""
    count = len(words) - WINDOW + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = len(numbers)
    pairs = code[:-1] * size + code[1:]
    if size > 1_000_000:  # keeps the product of three codes within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1].reshape(-1).astype(np.int64)
    windows = pairs[:count] * size + code[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(count, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(len(words), bool)
    for shift in range(WINDOW):
        inside[shift:shift + count] |= again
    return int(inside.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The numbers in MEASURES. Words are what stands between the six ASCII blanks; lines are cut at line feeds."""
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode("utf-8", "surrogatepass")
    # on bytes, split() and strip() know the six ASCII blanks only
    words = data.split()
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    lines = [line for line in data.split(b"\n") if line.strip()]
    ended = sum(line.rstrip()[-1:] in b".!?:;\"')" for line in lines)
    folded = np.frombuffer(data, np.uint8)
    upper = int(((folded >= 65) & (folded <= 90)).sum())
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
        len(lines), upper, text.count("!") + text.count("?"), ended,
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, MEASURES) per row, each a long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([measure(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(MEASURES))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(made[:, i]) for i in range(len(MEASURES)))], names=[id_col, *MEASURES])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {dict(rows.dtypes)[id_col]}, " + ", ".join(f"{m} long" for m in MEASURES)
    return map_arrow(rows, run, schema)


def _vote(value: Column, good: Column, bad: Column) -> Column:
    """1 good, -1 bad, 0 abstains; a value that cannot be computed abstains."""
    return F.when(value.isNull(), 0).when(good, 1).when(bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """The voters, as expressions over the measures."""
    words, lines = F.col("n_words"), F.col("n_lines")
    per_word = lambda name: F.col(name) / F.when(words > 0, words)
    per_line = lambda name: F.col(name) / F.when(lines > 0, lines)
    length, symbols, marks = per_word("word_chars"), per_word("n_symbols"), per_word("n_marks")
    again, double, ended = per_word("n_repeat_words"), per_line("n_dup_lines"), per_line("n_ended")
    upper = F.col("n_upper") / F.when(F.col("word_chars") > 0, F.col("word_chars"))
    return {
        "vote_words": _vote(words, words >= 50, words < 10),
        "vote_length": _vote(length, length.between(3, 10), (length < 2) | (length > 15)),
        "vote_symbols": _vote(symbols, symbols <= 0.02, symbols > 0.1),
        "vote_lines": _vote(double, double <= 0.1, double > 0.6),
        "vote_repeats": _vote(again, again <= 0.1, again > 0.45),
        "vote_upper": _vote(upper, upper <= 0.15, upper > 0.4),
        "vote_marks": _vote(marks, marks <= 0.05, marks > 0.3),
        "vote_ended": _vote(ended, ended >= 0.5, (lines >= 5) & (ended < 0.1)),
    }


def estimate(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Log odds of good before any vote, and what each rule's vote adds to them: an array (rules, 3) for -1, 0, 1.

    A latent class model by expectation-maximisation over the patterns of votes and their counts. Classes start from
    the patterns without and with a bad vote, and this start has half the weight in each estimate, so that the classes
    cannot drift to another grouping; a little of each vote is assumed in each class.
    """
    if not len(votes):
        return 0.0, np.zeros((votes.shape[1] if votes.ndim == 2 else 0, 3))
    first = np.where((votes < 0).any(1), 0.02, 0.98)
    good = first
    for _ in range(ROUNDS):
        mean = (first + good) / 2
        weight = counts[:, None] * np.stack([1 - mean, mean], axis=1)
        prior = weight.sum(0) + 1
        table = np.stack([[(weight[votes[:, j] == v].sum(0) + 0.5) for v in (-1, 0, 1)] for j in range(votes.shape[1])])
        table /= table.sum(1, keepdims=True)
        adds = np.log(table[:, :, 1]) - np.log(table[:, :, 0])
        adds[:, 1] = 0  # who abstains says nothing
        start = float(np.log(prior[1]) - np.log(prior[0]))
        odds = start + sum(adds[j, votes[:, j] + 1] for j in range(votes.shape[1]))
        new = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return start, adds


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, MEASURES, votes, posterior) per row: each rule's vote and the probability of good quality.

    Null and empty texts have measures of 0; ids may be null or repeat; other columns are ignored; an empty table gives
    an empty result. All rows are counted for the estimate: what reaches the driver is one count for each pattern of
    votes, at most 3 to the number of rules.
    """
    voters = rules()
    rows = keep_table(measures(docs, id_col, text_col).select(id_col, *MEASURES, *[v.alias(n) for n, v in voters.items()]),
                      "quality")
    patterns = rows.groupBy(*voters).agg(F.count(F.lit(1)).alias("n")).collect()
    votes = np.array([[r[n] for n in voters] for r in patterns], int).reshape(-1, len(voters))
    start, adds = estimate(votes, np.array([r["n"] for r in patterns], float))
    terms = [
        F.element_at(F.array(*[F.lit(float(x)) for x in adds[j]]) if len(adds) else F.array(*[F.lit(0.0)] * 3), F.col(n) + 2)
        for j, n in enumerate(voters)
    ]
    odds = reduce(lambda a, b: a + b, terms, F.lit(start))
    return rows.withColumn("posterior", 1 / (1 + F.exp(-odds)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict."""
    judged = judge(read(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= KEEP_FROM)).alias("kept"), "posterior",
    )
