import random

import numpy as np
import xxhash

from cases import ODD, SMALL, none, odd, table
from inkwell.llm import components, simhash
from inkwell.llm.queries import QUERIES


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id of each id's group; prints: id -> fingerprint."""
    ids = sorted(prints)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for at, a in enumerate(ids):
        for b in ids[at + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_against_plain_python(spark):
    prints = {r["doc_id"]: plain_print(r["text"]) for r in table("documents")}
    groups = plain_groups(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op4_simhash"](spark, SMALL).collect()}
    assert got == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}


def links_of(spark, prints):
    rows = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    return simhash.near_links(rows)


def test_links_connect_what_brute_force_connects(spark, monkeypatch):
    rnd = random.Random(4)
    prints = set()
    for _ in range(60):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            p = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 5)):
                p ^= 1 << bit
            prints.add(p)
    prints = sorted(prints)
    want = plain_groups(dict(enumerate(prints)))
    for block in (simhash.BLOCK, 3):  # keys in one block, and hot keys cut into several
        monkeypatch.setattr(simhash, "BLOCK", block)
        labels = components.components(links_of(spark, prints)).collect()
        signed = {int(np.uint64(p).astype(np.int64)): i for i, p in enumerate(prints)}
        top = {signed[r["node"]]: r["label"] for r in labels}
        groups = {}
        for i in range(len(prints)):
            groups.setdefault(top.get(i, ("alone", i)), set()).add(i)
        wanted = {}
        for i, g in want.items():
            wanted.setdefault(g, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_wider_radius_on_a_ring_of_eight(spark, monkeypatch):
    rnd = random.Random(6)
    prints = set()
    for _ in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 8)):
            p = centre
            for bit in rnd.sample(range(64), rnd.randint(0, 8)):
                p ^= 1 << bit
            prints.add(p)
    prints = sorted(prints)
    signed = {int(np.uint64(p).astype(np.int64)): p for p in prints}
    want = components_by(lambda p, q: (p ^ q).bit_count() <= 7, prints)
    assert want != components_by(lambda p, q: (p ^ q).bit_count() <= 6, prints)
    rows = spark.createDataFrame([(p,) for p in signed], "fp long")
    for block in (simhash.BLOCK, 3):
        monkeypatch.setattr(simhash, "BLOCK", block)
        links = {(signed[r["a"]], signed[r["b"]]) for r in simhash.near_links(rows, 7, 8).collect()}
        assert components_by(lambda p, q: (p, q) in links or (q, p) in links, prints) == want


def components_by(linked, nodes):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for at, p in enumerate(nodes):
        for q in nodes[at + 1:]:
            if linked(p, q):
                x, y = sorted((find(p), find(q)))
                top[y] = x
    return {n: find(n) for n in nodes}


def test_links_stay_few_in_a_dense_group(spark):
    centre = 0x123456789ABCDEF0
    prints = {centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    found = links_of(spark, prints).collect()
    assert len(found) <= 8 * len(prints)


def test_chain_keeps_all_near_pairs_and_drops_far_ones():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 5000, dtype=np.int64)
    b = a.copy()
    for _ in range(6):
        b ^= np.int64(1) << rng.integers(0, 63, 5000, dtype=np.int64)
    near = np.array([bin(int(x) & (2**64 - 1)).count("1") <= 3 for x in a ^ b])
    passed = np.zeros(5000, bool)
    for start in range(4):
        passed |= simhash.passes_chain(a, b, np.full(5000, start))
    assert (passed == near).all()


def test_odd_rows(spark):
    got = sorted((r["doc_id"] or -1, r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(
        odd(spark, "fp", "component_id", "key")).collect())
    assert [(i, f) for i, f, _ in got] == sorted((i or -1, plain_print(t)) for i, t, *_ in ODD)
    assert {i: c for i, _, c in got} == {-1: None, 1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7}
    kept = simhash.one_of_each(odd(spark)).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == [-1, 1, 4, 4, 5, 6, 7]


def test_no_rows(spark):
    assert simhash.near_duplicates(none(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([*zip(order, order[1:]), (5, 5), (None, 3), (1000, 1001), (1001, 1000)], "a long, b long")
    got = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
