"""Toxicity by weak supervision.

Terms that tell toxic from other training documents (whole words and word beginnings) form the lexicons of many voters;
others look at patterns. A generative label model with a latent class estimates each voter's accuracy and, by a tree
over the voters, their correlations given the class; a linear classifier learns from its posterior labels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import held_out, in_sample, keep_table, map_arrow, read

SAMPLE = 20_000  # labelled rows that are learned from, in the mean; all, if fewer
PREFIXES = (4, 5, 6)
LEAST_DOCS = 3
LEAST_SHARE = 0.015  # of toxic sample documents that have the term
LEAST_LIFT = 80.0  # how much oftener a term stands in toxic documents
MOST_TERMS = 2000
LEXICONS = 8
TOXIC_FROM = 0.7
WORD = re.compile(r"[^\W\d_]+")
PATTERNS = ("many", "dense", "none", "shouts", "calls")


def terms_of(text: str) -> set[str]:
    """Candidate terms of a text: its lower-case words (=word) and their beginnings (^begin)."""
    words = set(WORD.findall(text.lower()))
    return {f"={w}" for w in words if len(w) > 2} | {f"^{w[:n]}" for n in PREFIXES for w in words if len(w) >= n}


@dataclass
class Model:
    """Plain values only, so that tasks get all they need; ``weights`` are one per term, then the patterns', then the bias."""

    terms: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=lambda: [0.0] * len(PATTERNS) + [-20.0])

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "weights": self.weights}

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.terms:
            return None
        if not hasattr(self, "_automaton"):
            by_text: dict[str, list[tuple[int, bool]]] = {}
            for i, term in enumerate(self.terms):
                by_text.setdefault(term[1:], []).append((i, term[0] == "="))
            self._automaton = ahocorasick.Automaton()
            for text, uses in by_text.items():
                self._automaton.add_word(text, (len(text), uses))
            self._automaton.make_automaton()
        return self._automaton

    def look(self, text: str | None) -> tuple[list[int], list[float]]:
        """The numbers of the terms found in a text, and the values of the patterns."""
        text = text or ""
        lower = text.lower()
        found: set[int] = set()
        hits = 0
        automaton = self.automaton()
        for last, (length, uses) in automaton.iter(lower) if automaton and lower else ():
            first = last - length + 1
            if first and lower[first - 1].isalpha():
                continue
            ends = last + 1 == len(lower) or not lower[last + 1].isalpha()
            for number, whole in uses:
                if ends or not whole:
                    found.add(number)
                    hits += 1
        words = text.count(" ") + text.count("\n") + 1
        calls = text.count("!!") + text.count("??")
        return sorted(found), [
            float(len(found) > 1), float(hits * 100 >= words and hits > 0), float(not found), float(text.isupper()),
            float(calls * 10 > words),
        ]

    def score(self, text: str | None) -> float:
        found, patterns = self.look(text)
        n = len(self.terms)
        total = self.weights[-1] + sum(self.weights[i] for i in found)
        total += sum(w * v for w, v in zip(self.weights[n:], patterns))
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, total))))


def votes_of(found: list[int], patterns: list[float]) -> list[int]:
    """2 toxic, 0 clean, 1 abstains, for each voter: the lexicons, then the patterns."""
    lexicons = {i % LEXICONS for i in found}
    many, dense, none, shouts, calls = patterns
    return [2 if j in lexicons else 1 for j in range(LEXICONS)] + [
        2 if many else 1, 2 if dense else 1, 0 if none else 1, 2 if shouts else 1, 2 if calls else 1]


def _tree(votes: np.ndarray, weight: np.ndarray) -> list[int]:
    """Parents (-1: none) of a maximum spanning tree by mutual information given the class. weight: (rows, 2)."""
    m = votes.shape[1]
    info = np.zeros((m, m))
    hot = (votes[:, :, None] == np.arange(3)).astype(float)  # rows, voters, values
    for y in (0, 1):
        w = weight[:, y]
        mass = w.sum()
        if mass < 1:
            continue
        joint = np.einsum("r,rja,rkb->jkab", w, hot, hot) / mass + 1e-9
        single = np.einsum("r,rja->ja", w, hot) / mass + 1e-9
        info += mass / weight.sum() * (joint * np.log(joint / (single[:, None, :, None] * single[None, :, None, :]))).sum((2, 3))
    parent, best, link = [-1] * m, info[0].copy(), np.zeros(m, int)
    inside = np.zeros(m, bool)
    inside[0] = True
    for _ in range(m - 1):
        j = int(np.argmax(np.where(inside, -np.inf, best)))
        parent[j] = int(link[j]) if best[j] > 0.01 else -1
        inside[j] = True
        nearer = info[j] > best
        best, link = np.where(nearer, info[j], best), np.where(nearer, j, link)
    return parent


def label_model(votes: np.ndarray, counts: np.ndarray, known: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Posterior probability of class 1 (toxic) for each pattern of votes, by expectation-maximisation.

    Given the class, a voter's vote depends on the vote of its parent in the tree, so voters that share what they look
    at do not count twice. Starts from the majority of votes.
    """
    q = 1 / (1 + np.exp(-2.0 * ((votes == 2).sum(1) - (votes == 0).sum(1) - 0.5)))
    parent = [-1] * votes.shape[1]
    for step in range(rounds):
        mean = (q + known) / 2
        weight = counts[:, None] * np.stack([1 - mean, mean], axis=1)
        if step % 10 == 0:
            parent = _tree(votes, weight)
        log = np.log(weight.sum(0) + 1)[None, :].repeat(len(votes), 0)
        for j, p in enumerate(parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            table = np.full((2, 3, 3), 0.3)
            for y in (0, 1):
                np.add.at(table[y], (given, votes[:, j]), weight[:, y])
            table /= table.sum(2, keepdims=True)
            log += np.log(table[:, given, votes[:, j]]).T
        q = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))
    return q


def _fit(rows: np.ndarray, soft: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Weights and bias of a logistic regression on soft labels."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    share = counts / counts.sum()
    for step in range(1, steps + 1):
        gradient = x.T @ (share * (1 / (1 + np.exp(-x @ w)) - soft)) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w


def _counted(docs: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(term, toxic, docs): documents that have each term, all terms or the wanted ones; summed up in each batch first."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            terms = terms_of(text or "")
            counts.update((t, toxic) for t in (terms if wanted is None else terms & wanted))
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([counts[k] for k in keys], pa.int64())], names=["term", "toxic", "docs"])

    made = map_arrow(docs.select("text", "toxic"), run, "term string, toxic int, docs long")
    return made.groupBy("term", "toxic").agg(F.sum("docs").alias("docs"))


def _contexts(docs: DataFrame, wanted: set[str]) -> DataFrame:
    """(term, contexts): in how many different pairs of neighbouring words each term stands."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen: set[tuple[str, int]] = set()
        for text in batch.column(0).to_pylist():
            words = ["", *WORD.findall((text or "").lower()), ""]
            for before, word, after in zip(words, words[1:], words[2:]):
                for term in (f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) >= n)):
                    if term in wanted:
                        seen.add((term, zlib.crc32(f"{before} {after}".encode("utf-8", "replace"))))
        rows = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.int64())], names=["term", "context"])

    made = map_arrow(docs.select("text"), run, "term string, context long")
    return made.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("contexts"))


def standing_out(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> set[str]:
    return {t for t, n in toxic.items() if n / n_toxic >= LEAST_LIFT * clean.get(t, 0) / n_clean}


def choose_terms(toxic: dict[str, int]) -> list[str]:
    """Of terms with their counts, shortest beginnings first; a term that a chosen beginning covers is left out."""
    good = list(toxic)
    chosen: list[str] = []
    begins: set[str] = set()
    for term in sorted(good, key=lambda t: (t[0] == "=", len(t), t)):
        if not any(term[1:n + 1] in begins for n in PREFIXES):
            chosen.append(term)
            if term[0] == "^":
                begins.add(term[1:])
    return sorted(chosen, key=lambda t: (-toxic[t], t))[:MOST_TERMS]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from documents with a label whose id is not held out, at most about ``SAMPLE`` of them.

    Labels (id, toxic) that are null count as none, of several for one id the largest holds. Without toxic or without
    clean examples the model finds nothing (score near 0). What reaches the driver is bounded by the sample: term
    counts over a least share of documents, vote patterns, and their term lists.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(
        F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, SAMPLE / max(1, n))
    picked = known.where(in_sample(share, F.col(id_col)))
    sample = docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(picked, id_col)
    sample = keep_table(sample.select("text", "toxic"), "toxic-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    least = max(min(LEAST_DOCS, n_toxic), LEAST_SHARE * n_toxic)
    often = _counted(sample.where("toxic = 1"), None).where(F.col("docs") >= least)
    toxic = {r["term"]: r["docs"] for r in often.collect()}
    clean = {r["term"]: r["docs"] for r in _counted(sample.where("toxic = 0"), set(toxic)).collect()}
    good = standing_out(toxic, clean, n_toxic, n_clean)
    # copies of one document share all its rare words: what counts is in how many different places a term stands
    placed = _contexts(sample.where("toxic = 1"), good).where(F.col("contexts") >= least).collect()
    model = Model(choose_terms({r["term"]: r["contexts"] for r in placed}))
    model.weights = [0.0] * len(model.terms) + model.weights

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = [model.look(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in seen], pa.list_(pa.int32())), pa.array([p for _, p in seen], pa.list_(pa.float64())),
             batch.column(1)], names=["found", "patterns", "toxic"])

    looked = map_arrow(sample.select("text", "toxic"), look, "found array<int>, patterns array<double>, toxic int")
    rows = looked.groupBy("found", "patterns").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).collect()
    counts = np.array([r["n"] for r in rows], float)
    votes = np.array([votes_of(r["found"], r["patterns"]) for r in rows])
    distinct, which = np.unique(votes, axis=0, return_inverse=True)
    which = which.reshape(-1)
    given = np.bincount(which, [r["toxic"] for r in rows])
    seen = np.bincount(which, counts)
    soft = label_model(distinct, seen, given / seen)[which]
    # most documents have no term: the few that have one weigh as much in all
    x = np.zeros((len(rows), len(model.terms) + len(PATTERNS)), np.float32)
    for i, r in enumerate(rows):
        x[i, r["found"]] = 1
        x[i, len(model.terms):] = r["patterns"]
    some = np.array([bool(r["found"]) for r in rows])
    balance = np.where(some, counts / max(1, counts[some].sum()), counts / max(1, counts[~some].sum()))
    model.weights = [float(w) for w in _fit(x, soft, balance)]
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) per row: probability of toxicity from the whole text, and whether it reaches TOXIC_FROM.

    Null texts are scored as empty ones; ids may be null or repeat; other columns are ignored; no rows give no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [model.score(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    made = map_arrow(rows, run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, score double")
    return made.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text the model does not reject, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = [model.score(t) < TOXIC_FROM for t in batch.column(place).to_pylist()]
        yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score."""
    docs = read(spark, sf_dir, "documents")
    model = train(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
