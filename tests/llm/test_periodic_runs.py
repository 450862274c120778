import hashlib
import random
import time
import zlib

import numpy as np

from cases import SMALL, none, odd, table
from inkwell.llm import periodic_runs as P
from inkwell.llm.queries import QUERIES


def plain(words):
    """All runs by trying every period and every start."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # periods rise, so the smallest stays
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def changed(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def test_query_against_plain_python(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    docs = table("documents")
    assert len(rows) == len(docs)
    planted = 0
    for d in docs:
        words = changed(d["doc_id"], (d["text"] or "").encode().split())
        if len(words) > 3000:
            continue
        runs, r = plain(words), rows[d["doc_id"]]
        planted += bool(runs)
        assert r["n_runs"] == len(runs)
        listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs)).hexdigest()
        if runs:
            from fractions import Fraction
            best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (*best, 1000 * best[1] // best[2])
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
    assert planted > 10


def test_random_sequences_of_few_and_many_words():
    rng = random.Random(3)
    for case in range(400):
        n, kinds = rng.randint(0, 300), rng.choice([1, 2, 3, 50])
        codes = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):  # plant runs over each other
            if n > 8:
                at = rng.randrange(n)
                q = rng.randint(1, max(1, (n - at) // 4))
                for i in range(at + q, min(n, at + rng.randint(3, 7) * q)):
                    codes[i] = codes[i - q]
        assert P.runs_of(np.array(codes, np.int64)) == plain(codes), case


def test_every_period_around_the_scales():
    rng = random.Random(4)
    for q in [*range(1, 70), 127, 128, 129, 255, 256, 257, 1000]:
        passage = [rng.randrange(10 ** 6) for _ in range(q)]
        for length in {max(6, 4 * q), 5 * q + q // 2}:
            codes = [-1, *(passage * 7)[:length], -2]
            want = [(1, length, q)] if length >= max(6, 4 * q) else []
            assert P.runs_of(np.array(codes, np.int64)) == want
        short = [-1, *(passage * 7)[:max(6, 4 * q) - 1], -2]
        assert P.runs_of(np.array(short, np.int64)) == []


def test_passages_that_repeat_parts_of_themselves():
    """Periods such as a a a b: stretches shorter than the period are equal inside it."""
    rng = random.Random(5)
    for _ in range(200):
        piece = [rng.randrange(2) for _ in range(rng.randint(1, 6))]
        period = piece * rng.randint(1, 12) + [rng.randrange(3) for _ in range(rng.randint(0, 4))]
        codes = [7, *(period * 5)[:rng.randint(4 * len(period), 5 * len(period))], 8, 8]
        assert P.runs_of(np.array(codes, np.int64)) == plain(codes)


def test_a_very_long_text():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 50_000, 1_000_000)
    codes[300_000:700_000] = np.tile(codes[300_000:380_000], 5)
    start = time.time()
    assert P.runs_of(codes) == plain_runs_at(codes, 80_000)
    assert P.runs_of(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    assert time.time() - start < 60


def plain_runs_at(codes, q):
    same = np.flatnonzero(codes[:-q] == codes[q:])
    inside = same[(same >= 300_000) & (same < 620_000)]
    assert len(inside) == 320_000
    return [(300_000, 400_000, q)]


def test_texts_together_do_not_touch(monkeypatch):
    texts = [[b"a"] * 3, [b"a"] * 3, [], [b"a"] * 9, [b"x", b"y"] * 4]
    for together in (1, 5, 10 ** 6):
        monkeypatch.setattr(P, "TOGETHER", together)
        assert P.runs_of_texts(texts) == [[], [], [], [(0, 9, 1)], [(0, 8, 2)]]


def test_odd_rows_and_none(spark):
    rows = P.periodic_runs(odd(spark, "runs", "n_words", "collapsed", "strongest")).collect()
    assert len(rows) == 9
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["runs"] == [] and by_id[1]["collapsed"] == "" and by_id[2]["n_words"] == 0
    assert by_id[3]["strongest"] is None
    assert [tuple(x) for x in by_id[6]["runs"]] == [(0, 40_000, 1)] and by_id[6]["collapsed"] == "word " + "x" * 30_000
    assert by_id[5]["collapsed"] == "Ünïcode 日本語 \x00 🙂 text"
    assert P.planted(None, [b"a"] * 9) == [b"a"] * 9
    assert P.periodic_runs(none(spark)).count() == 0
