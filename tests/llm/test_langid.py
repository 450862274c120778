import zlib

import numpy as np
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from cases import SMALL, none, odd
from inkwell.llm import langid
from inkwell.llm.common import read
from inkwell.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = {r["doc_id"]: r for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}
    rows = QUERIES["op6_langid"](spark, folder).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in unseen)
    assert right >= 0.97 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_subwords_do_not_depend_on_blocks(monkeypatch):
    text = "Über allen Gipfeln ist Ruh, in allen Wipfeln spürest du 12 34 " * 40
    whole = langid.subwords(text)
    monkeypatch.setattr(langid, "BLOCK", 101)
    assert (langid.subwords(text) == whole).all()


def test_odd_rows(spark):
    rows = [(i, "the cat and the dog " * 3 if i % 2 else "der hund und die katze " * 3, "en" if i % 2 else "de", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    model = langid.train(docs)
    assert model.langs == ["de", "en"]
    assert model.predict("the dog")[0] == "en" and model.predict("die katze")[0] == "de"
    found = {r["doc_id"]: r for r in langid.identify(odd(spark, "score", "lang_pred"), model).collect()}
    for i in (1, 2, 3, 7):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["accepted"]) == ("und", 0.0, False)
    assert found[6]["lang_pred"] in ("de", "en") and found[None]["lang_pred"] in ("de", "en")


def test_nothing_to_learn_from_and_no_rows(spark):
    model = langid.train(none(spark))
    assert model.predict("some text") == ("und", 0.0)
    assert langid.identify(none(spark), model).count() == 0


def test_calibration_rejects_what_is_like_no_language():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(300):
        lang = i % 3
        words = rng.choice([["alpha", "beta", "gamma"], ["uno", "dos", "tres"], ["eins", "zwei", "drei"]][lang], 12)
        counts = langid.subwords(" ".join(words))
        hit = np.flatnonzero(counts)
        rows.append((hit, counts[hit] / counts.sum()))
        labels.append(lang)
    model = langid.fit(rows, np.array(labels), ["a", "b", "c"])
    sure, unsure = model.predict("uno dos tres uno")[1], model.predict("kkkk wwww qqqq")[1]
    assert sure > 0.9 > unsure


def test_digits_of_any_kind_are_no_letters(spark):
    model = langid.train(read(spark, SMALL, "documents"))
    for text in ("½ ² ① Ⅷ", "12 3.4 _", "١٢", "", None):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("½ the end")[0] != "und"


def test_samples_at_any_size(spark):
    from inkwell.llm.common import in_sample

    rows = spark.range(200_000).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS id", "cast(id AS string) AS text")
    for share in (0.3, 1e-3):
        picked = rows.where(in_sample(share, F.col("id"), F.col("text"))).groupBy(F.col("id").isNull().alias("none")).count().collect()
        for r in picked:  # rows with and without an id alike
            assert abs(r["count"] - 100_000 * share) < 6 * (100_000 * share) ** 0.5
    assert rows.where(in_sample(1.0, F.col("id"), F.col("text"))).count() == 200_000
    tiny = rows.select(in_sample(2e-7, F.lit(5), F.col("text")).alias("x"), F.lit(1).alias("y"))
    assert tiny.count() == 200_000  # below a millionth the last digits decide, so it never becomes a constant of false
