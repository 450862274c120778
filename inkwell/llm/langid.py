"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by stochastic gradient
descent in numpy, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import held_out, in_sample, keep_table, map_arrow, read

SAMPLE = 4_000  # rows with a language that are learned from, in the mean; all, if fewer
BUCKETS = 1 << 13
DIMENSIONS = 16
EPOCHS = 12
BATCH = 32
RATE = 0.5
PRECISION = 0.99  # wanted among accepted predictions
BLOCK = 1 << 20  # bytes of a text whose subwords are hashed at once

# Bytes that are not letters end a word; bytes above 127 belong to letters of other scripts.
_FOLD = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def subwords(text: str) -> np.ndarray:
    """How often each bucket is hit by the 3 and 4 byte pieces of the text's words, blanks around them included."""
    data = b" " + text.lower().encode("utf-8", "replace") + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(1, len(data) - 3), BLOCK):
        b = _FOLD[np.frombuffer(data[start:start + BLOCK + 3], np.uint8)]
        if len(b) < 3:
            break
        inner = b[1:-1] != 32
        h = b[:-2] * np.uint32(2654435761) ^ b[1:-1] * np.uint32(2246822519) ^ b[2:] * np.uint32(3266489917)
        # pieces of 3 that begin in the overlap of two blocks belong to the next
        own = np.arange(len(inner)) < BLOCK if start + BLOCK + 3 < len(data) else np.ones(len(inner), bool)
        counts += np.bincount((h[inner & own] >> np.uint32(19)), minlength=BUCKETS)
        if len(b) > 3:
            inner4 = inner[:-1] & inner[1:]
            h4 = h[:-1] * np.uint32(668265263) ^ b[3:] * np.uint32(374761393)
            counts += np.bincount((h4[inner4] >> np.uint32(19)), minlength=BUCKETS)
    return counts


class Model:
    """Languages, embeddings times output weights (buckets x languages), temperature, and the least accepted score."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, accept: float) -> None:
        self.langs, self.table, self.bias, self.temperature, self.accept = langs, table, bias, temperature, accept

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its calibrated probability; 'und' and 0 for a text without a letter."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        counts = subwords(text)
        logits = counts @ self.table / max(1, counts.sum()) + self.bias
        p = _softmax(logits[None, :] / self.temperature)[0]
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (at, share) in enumerate(rows):
        x[i, at] = share
    return x


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, langs: list[str]) -> Model:
    """rows: bucket numbers and their shares of each text. Every tenth row calibrates and is not trained on."""
    rng = np.random.default_rng(0)
    order = rng.permutation(len(rows))
    check, learn = (order[::10], np.setdiff1d(order, order[::10])) if len(rows) >= 50 else (order, order)
    emb = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    out = rng.normal(0, 0.1, (DIMENSIONS, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps = EPOCHS * max(1, -(-len(learn) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for start in range(0, len(learn), BATCH):
            part = learn[start:start + BATCH]
            # shares are small, so they are scaled to make a step felt
            x = _dense([rows[i] for i in part]) * 8
            hidden = x @ emb
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(part)), labels[part]] -= 1
            error *= RATE * (1 - step / steps) / len(part)
            back = error @ out.T
            out -= hidden.T @ error
            bias -= error.sum(0)
            emb -= x.T @ back
            step += 1
    table = (emb @ out * 8).astype(np.float64)
    logits = np.concatenate([_dense([rows[i] for i in check[s:s + 256]]) @ table for s in range(0, len(check), 256)]) + bias
    truth = labels[check]
    temperatures = np.exp(np.linspace(-2, 3, 51))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    best, right = p.max(1), p.argmax(1) == truth
    # the least score from which predictions are right often enough
    by_score = np.argsort(-best)
    precise = np.cumsum(right[by_score]) / np.arange(1, len(by_score) + 1) >= PRECISION
    accept = float(best[by_score][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return Model(langs, table, bias.astype(np.float64), temperature, accept)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from about ``SAMPLE`` rows, twice as many at most, whose id is not held out and whose text and language are
    not null.

    The sample is drawn by a hash of the id, for null ids of the text. Without such rows the model knows no language and says 'und'.
    """
    known = docs.select(id_col, F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(id_col))
    share = min(1.0, SAMPLE / max(1, known.count()))
    picked = known.where(in_sample(share, F.col(id_col), F.col("text")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, shares = [], []
        for text in batch.column(0).to_pylist():
            counts = subwords(text)
            hit = np.flatnonzero(counts)
            at.append(hit.astype(np.int16))
            shares.append((counts[hit] / max(1, counts.sum())).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(at, pa.list_(pa.int16())), pa.array(shares, pa.list_(pa.float32()))],
            names=["lang", "at", "shares"])

    made = map_arrow(picked.select("text", "lang"), run, "lang string, at array<smallint>, shares array<float>")
    # of very many repeats of one row all are drawn or none
    made = keep_table(made.limit(2 * SAMPLE), "language-sample")
    table = made.toArrow()
    names = table["lang"].to_pylist()
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    langs = sorted(set(names))
    rows = [(np.array(a.values.to_numpy(zero_copy_only=False)), np.array(s.values.to_numpy(zero_copy_only=False)))
            for a, s in zip(table["at"], table["shares"])]
    return fit(rows, np.array([langs.index(n) for n in names]), langs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) per row, from the whole text.

    ``accepted`` is false where the calibrated score is below the one at which predictions were right in ``PRECISION``
    of the cases. Null texts and texts without a letter are 'und' with score 0 and not accepted. Ids may be null or
    repeat, other columns are ignored, no rows give no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [model.predict(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
            names=[id_col, "lang_pred", "score"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    found = map_arrow(rows, run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, lang_pred string, score double")
    return found.withColumn("accepted", (F.col("lang_pred") != "und") & (F.col("score") >= model.accept))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language."""
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "accepted")
