import zlib

import numpy as np

from cases import SMALL, none, odd
from inkwell.llm import toxicity
from inkwell.llm.queries import QUERIES

DOCS = "doc_id long, text string, score string"
LABELS = "doc_id long, toxic int"


def corpus(n=900):
    """Documents of made-up words; every fifth has one or two of a few words that only they have."""
    rng = np.random.default_rng(7)
    plain = ["".join(rng.choice(list("abcdeilmnorstu"), rng.integers(3, 8))) for _ in range(400)]
    bad = ["zorg", "krull", "vexing", "vexed", "pfft"]
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, 40))
        if i % 5 == 0:
            for w in rng.choice(bad, rng.integers(1, 3), replace=False):
                words.insert(rng.integers(0, 40), str(w))
        docs.append((i, " ".join(words), "mine"))
        labels.append((i, int(i % 5 == 0)))
    return docs, labels


def test_finds_held_out_toxic_documents(spark):
    docs, labels = corpus()
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    rows = toxicity.score(spark.createDataFrame(docs, DOCS), model).collect()
    unseen = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    toxic = [r for r in unseen if r["doc_id"] % 5 == 0]
    clean = [r for r in unseen if r["doc_id"] % 5]
    assert sum(r["predicted"] for r in toxic) >= 0.95 * len(toxic)
    assert sum(r["predicted"] for r in clean) == 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    kept = toxicity.without_toxic(spark.createDataFrame(docs, DOCS), model)
    assert kept.columns == ["doc_id", "text", "score"]
    assert kept.count() == sum(not r["predicted"] for r in rows)


def test_learns_nothing_from_held_out_labels(spark):
    docs, labels = corpus()
    held = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(held, LABELS))
    assert model.terms == [] and model.score(docs[0][1]) < 0.01


def test_copies_of_one_document_make_no_terms(spark):
    docs, labels = corpus(300)
    docs += [(1000 + i, f"copied rareword passage number {i % 2}", "mine") for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert not any("rare" in t or "copi" in t for t in model.terms)


def test_label_model_counts_equal_voters_once():
    rng = np.random.default_rng(3)
    toxic = rng.random(6000) < 0.3
    a = np.where(rng.random(6000) < 0.85, toxic, ~toxic)
    b = np.where(rng.random(6000) < 0.85, toxic, ~toxic)
    votes = np.stack([np.where(v, 2, 0) for v in (a, a, a, a, b)], axis=1)  # four copies of one voter
    distinct, which = np.unique(votes, axis=0, return_inverse=True)
    counts = np.bincount(which.reshape(-1)).astype(float)
    known = np.bincount(which.reshape(-1), toxic) / counts
    soft = toxicity.label_model(distinct, counts, known)
    apart = soft[[tuple(v) == (2, 2, 2, 2, 0) for v in distinct.tolist()]][0]
    assert 0.1 < apart < 0.9


def test_odd_rows_and_none(spark):
    docs, labels = corpus(300)
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(None, 1), (3, None), (4, 0), (4, 0)], LABELS))
    rows = toxicity.score(odd(spark, "predicted", "toxic"), model).collect()
    assert len(rows) == 9 and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(none(spark), model).count() == 0
    assert toxicity.train(none(spark), spark.createDataFrame([], LABELS)).terms == []


def test_query_covers_the_table(spark):
    rows = QUERIES["op7_toxicity"](spark, SMALL).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == 200
