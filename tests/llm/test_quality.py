import re

import numpy as np

from cases import SMALL, none, odd, table
from inkwell.llm import quality
from inkwell.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_query_against_plain_python(spark):
    want = {r["doc_id"]: plain(r["text"]) for r in table("documents") if len(r["text"] or "") < 8000}
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, SMALL).collect()}
    assert len(rows) == len(table("documents"))
    for i, numbers in want.items():
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == numbers
        assert r["base_failed"] == (numbers[0] < 50 or 100 * numbers[4] > 50 * numbers[0])
        assert not (r["kept"] and r["base_failed"])


def test_keeps_good_documents_and_drops_junk(spark):
    labels = {r["doc_id"]: r["quality"] for r in table("labels")}
    rows = [r for r in QUERIES["op5_quality"](spark, SMALL).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]] == 1]
    assert sum(good) >= 0.99 * len(good)


def test_repeats_with_many_different_words():
    words = [str(i).encode() for i in range(1_100_000)] + [b"1", b"2", b"3"]
    assert quality.repeated_words(words) == 6


def test_estimate_tells_reliable_from_unreliable_rules():
    rng = np.random.default_rng(0)
    good = rng.random(4000) < 0.8
    accurate = np.where(rng.random(4000) < 0.95, good, ~good)
    random = rng.random(4000) < 0.5
    votes = np.stack([np.where(v, 1, -1) for v in (accurate, accurate ^ (rng.random(4000) < 0.05), random)], axis=1)
    distinct, counts = np.unique(votes, axis=0, return_counts=True)
    _, adds = quality.estimate(distinct, counts.astype(float))
    assert adds[0, 2] - adds[0, 0] > adds[2, 2] - adds[2, 0]
    assert not adds[:, 1].any()


def test_odd_rows_and_none(spark):
    rows = quality.judge(odd(spark, "n_words", "posterior", "vote_words")).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == 9
    assert [by_id[1][m] for m in quality.MEASURES] == [0] * 9 == [by_id[2][m] for m in quality.MEASURES]
    assert by_id[3]["n_words"] == 0 and by_id[5]["n_words"] == 5 and by_id[6]["n_words"] == 40_001
    assert quality.judge(none(spark)).count() == 0
