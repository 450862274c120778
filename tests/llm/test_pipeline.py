import base64
import hashlib
import os

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from cases import SMALL, none, odd, table
from inkwell.llm import pii, toxicity
from inkwell.llm.common import read
from test_near_copies import plain_kept


def test_against_plain_python(spark):
    """Each stage by plain Python, but for the trained model, which is trained once and applied text by text."""
    model = toxicity.train(read(spark, SMALL, "documents"), read(spark, SMALL, "labels").select("doc_id", "toxic"))
    docs = {r["doc_id"]: r["text"] for r in table("documents")}
    docs = {i: t for i, t in docs.items() if model.score(t) < toxicity.TOXIC_FROM}
    kept = plain_kept(docs)
    docs = {i: pii.mask(t) for i, t in docs.items() if i in kept}
    ranks = {base64.b64decode(w): int(n) for w, n in map(bytes.split, open(P.path(corpus_pipeline.RANKS), "rb").read().splitlines())}
    coding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        assert got[i]["ids"] == coding.encode_ordinary(text or "")
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_stages_keep_the_columns_and_cope_with_odd_rows(spark):
    docs = odd(spark, "mix_slot", "fp")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SMALL)
        assert made.columns == docs.columns, name
        assert stage(spark, none(spark), SMALL).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 9


def test_mix_stage_keeps_all_rows_in_the_order_of_the_mix(spark):
    docs = read(spark, SMALL, "documents")
    made = corpus_pipeline.mix_sources(spark, docs, SMALL)
    assert made.columns == docs.columns
    assert sorted(r["doc_id"] for r in made.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_nothing_outside_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for folder, _, files in os.walk(os.path.join(root, "inkwell")):
        for file in files:
            if file.endswith(".py") and not folder.endswith("llm"):
                assert "llm" not in open(os.path.join(folder, file)).read().split("import", 1)[-1].split(), file
