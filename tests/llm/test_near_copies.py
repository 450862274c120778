import random

import numpy as np

import corpus_pipeline
from cases import SCHEMA, SMALL, table
from inkwell.llm import near_copies
from inkwell.llm.common import read
from inkwell.llm.simhash import fingerprint


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(texts):
    """Smallest ids of the groups linked by a similarity from 0.8; texts: id -> text."""
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            x, y = sets[a], sets[b]
            if x == y or 10 * len(x & y) >= 8 * len(x | y) > 0:
                u, v = find(a), find(b)
                top[max(u, v)] = min(u, v)
    return {i for i in ids if find(i) == i}


def stay(spark, rows):
    made = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SMALL)
    return sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=repr)


def test_stage_against_brute_force(spark):
    docs = read(spark, SMALL, "documents")
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()]
    assert sorted(got) == sorted(plain_kept({r["doc_id"]: r["text"] for r in table("documents")}))


def test_groups_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 3)
    rnd = random.Random(5)
    texts = {}
    for group in range(6):
        words = [f"w{rnd.randrange(500)}" for _ in range(200)]
        for _ in range(25):
            own = list(words)
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
            texts[len(texts)] = " ".join(own)
    rows = [(i, t, "en", "a", len(t)) for i, t in texts.items()]
    assert {i for i, _ in stay(spark, rows)} == plain_kept(texts)


def test_fingerprints_alone_find_what_lies_within_the_radius(spark, monkeypatch):
    """Without the bands, the pairs within 7 bits are linked, all of them, if they are similar enough."""
    rnd = random.Random(11)
    texts, near, far = {}, 0, 0
    for pair in range(60):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
        own = list(words)
        for _ in range(pair % 6):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
        texts[2 * pair], texts[2 * pair + 1] = " ".join(words), " ".join(own)
    kept = set(texts)
    for i in range(0, len(texts), 2):
        bits = (fingerprint(texts[i], 5) ^ fingerprint(texts[i + 1], 5)).bit_count()
        if texts[i] != texts[i + 1] and i + 1 not in plain_kept({k: texts[k] for k in (i, i + 1)}):
            near, far = near + (bits <= 7), far + (bits > 7)
        if bits <= 7 and len(plain_kept({k: texts[k] for k in (i, i + 1)})) == 1:
            kept.discard(i + 1)
    assert near > 20 and far
    monkeypatch.setattr(near_copies, "bands_for", lambda least: 0)
    assert {i for i, _ in stay(spark, [(i, t, "en", "a", len(t)) for i, t in texts.items()])} == kept
    monkeypatch.undo()
    assert {i for i, _ in stay(spark, [(i, t, "en", "a", len(t)) for i, t in texts.items()])} == plain_kept(texts)


def boilerplate(pairs, shared, own, differ):
    """Pairs of near copies that all share a passage of ``shared`` words; ``own`` words tell the pairs apart, and the
    two texts of a pair differ in ``differ`` further ones."""
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(shared)]
    texts = {}
    for _ in range(pairs):
        mine = [f"o{rnd.randrange(10**9)}" for _ in range(own)]
        for _ in range(2):
            texts[len(texts)] = " ".join([*passage, *mine, *[f"d{rnd.randrange(10**9)}" for _ in range(differ)]])
    return texts


def test_pairs_under_common_boilerplate_are_not_lost(spark, monkeypatch):
    """Keys that all texts share, none of them similar enough to the least one: every pair must still meet."""
    texts = boilerplate(150, 220, 8, 22)
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    near = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert near(0, 1) >= 0.8 > near(0, 2) > 0.7
    monkeypatch.setattr(near_copies, "BLOCK", 64)
    rows = [(i, t, "en", "a", len(t)) for i, t in texts.items()]
    assert [i for i, _ in stay(spark, rows)] == sorted((i for i in texts if i % 2 == 0), key=lambda i: repr((i, texts[i])))


def test_rarest_shingles_find_all_similar_sets():
    rnd = np.random.default_rng(3)
    base = [np.unique(rnd.integers(0, 400, rnd.integers(1, 60))).astype(np.uint64) for _ in range(20)]
    sets = []
    for _ in range(120):
        one = base[rnd.integers(len(base))]
        keep = one[rnd.random(len(one)) > rnd.choice([0, 0.05, 0.1, 0.2])]
        sets.append(np.unique(np.r_[keep, rnd.integers(0, 400, rnd.integers(0, 4)).astype(np.uint64)]))
    ids = np.arange(len(sets))
    for block in (np.zeros(len(sets), int), ids % 2):
        met = near_copies._Sets(ids, ids, block, sets)
        found = set(met.candidates(0.8))
        want = {(x, y) for x in ids for y in ids[x + 1:] if near_copies.similarity(sets[x], sets[y]) >= 0.8
                and (block[x] != block[y] or not block.any())}
        assert want and want <= found


def test_one_row_stays_of_copies_that_share_an_id_or_have_none(spark):
    def row(i, text):
        return (i, text, "en", "a", len(text))

    other = "a text of its own that stands under an id which a copy has as well"
    rows = [row(4, "same words twice over")] * 2 + [row(None, "copies that have no id at all")] * 3
    rows += [row(5, "one text that two ids have"), row(9, "One text  that two ids have"), row(9, other)]
    assert [(i, t.lower()) for i, t in stay(spark, rows)] == sorted([
        (4, "same words twice over"), (5, "one text that two ids have"), (9, other), (None, "copies that have no id at all")], key=repr)
    mixed = stay(spark, [row(None, "a text with and without an id"), row(8, "a text with and without an id")])
    assert mixed == [(8, "a text with and without an id")]
