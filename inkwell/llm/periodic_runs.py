"""Periodic runs of words: stretches that repeat one passage four times or more, found by minimizers at several scales.

Inside a run of period q the stretches of P >= q words are equal exactly where they stand a multiple of q apart. For each
scale P, a power of two, each window of P/2 starts gives its smallest hash of P words (its minimizer); inside a run with
P/2 < q <= P these stand again q words later, and equal ones that follow each other are a pair at the distance q. Pairs
are seeds: they are extended over the words themselves, so a hash never decides. Periods too short for the first scale
are found by comparing the words with those q places on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import map_arrow, read

REPEATS = 4
LEAST_LENGTH = 6
# Periods up to here are scanned directly; half the first scale.
SCANNED = 8
# Texts are put together until they have so many words, so that short ones share the work of a step.
TOGETHER = 200_000

Run = tuple[int, int, int]  # start, length, period


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.diff(np.concatenate([[0], same.view(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _scan(codes: np.ndarray, period: int) -> Iterator[Run]:
    """All maximal stretches in which words ``period`` apart are equal, if long enough for a run."""
    starts, ends = _stretches(codes[:-period] == codes[period:])
    long = ends - starts + period >= max(LEAST_LENGTH, REPEATS * period)
    for start, end in zip(starts[long].tolist(), ends[long].tolist()):
        yield start, end - start + period, period


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes side by side."""
    made = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    made ^= made >> np.uint64(32)
    return made * np.uint64(0xBF58476D1CE4E5B9)


def _sliding(values: np.ndarray, width: int, of: np.ufunc, fill: int) -> np.ndarray:
    """Minimum or maximum of each ``width`` consecutive values: running ones from both ends of blocks of that width."""
    blocks = -(-len(values) // width)
    filled = np.full((blocks, width), fill, np.uint64)
    filled.reshape(-1)[:len(values)] = values
    ahead = of.accumulate(filled, axis=1).reshape(-1)
    back = of.accumulate(filled[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = len(values) - width + 1
    return of(back[:count], ahead[width - 1:width - 1 + count])


def _minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions whose hash is the smallest of some ``window`` consecutive ones."""
    least = _sliding(hashes, window, np.minimum, 2 ** 64 - 1)
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, window, np.maximum, 0) == hashes)


def _seeds(codes: np.ndarray, hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, periods) of pairs of equal minimizers that follow each other, periods in (scale/2, scale].

    In a run some seed has three more periods of words behind it; pairs where samples of these differ are left out.
    """
    places = _minimizers(hashes, scale // 2)
    places = places[np.argsort(hashes[places], kind="stable")]
    first, second = places[:-1], places[1:]
    period = second - first
    fits = (hashes[first] == hashes[second]) & (period > scale // 2) & (period <= scale) & (first + 3 * period <= len(codes))
    first, period = first[fits], period[fits]
    for part in (lambda q: 0, lambda q: q // 2, lambda q: q - 1):
        at = first + period + part(period)
        alike = codes[at] == codes[at + period]
        first, period = first[alike], period[alike]
    order = np.lexsort((first, period))
    return first[order], period[order]


def _reach(codes: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on, in the direction ``step``, equal the ones ``period`` later: blocks of growing size."""
    last = len(codes) - period
    done, block = 0, 64
    while True:
        low, high = (at + done, min(at + done + block, last)) if step > 0 else (max(0, at - done - block + 1), at - done + 1)
        if low >= high:
            return done
        differ = np.flatnonzero(codes[low:high] != codes[low + period:high + period])
        if len(differ):
            return done + int(differ[0] if step > 0 else high - low - 1 - differ[-1])
        done += high - low
        block *= 2


def runs_of(codes: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a sequence of whole numbers, by start, then period.

    A run is a stretch whose smallest period is q, of max(6, 4 q) words at least, that no neighbour extends.
    """
    count = len(codes)
    found: dict[tuple[int, int], int] = {}  # a stretch is listed with its smallest period only

    def add(start: int, length: int, period: int) -> None:
        if length >= max(LEAST_LENGTH, REPEATS * period):
            found[start, length] = min(period, found.get((start, length), period))

    for period in range(1, min(SCANNED, count // REPEATS) + 1):
        for run in _scan(codes, period):
            add(*run)
    scale, hashes = 1, codes.astype(np.uint64) * np.uint64(0xFF51AFD7ED558CCD)
    # a run of this scale has more than 2 * scale words
    while count > 2 * scale and count > REPEATS * SCANNED:
        if scale > SCANNED:
            covered, before = -1, 0
            for at, period in zip(*(a.tolist() for a in _seeds(codes, hashes, scale))):
                if period == before and at < covered:
                    continue
                start = at + 1 - _reach(codes, at, period, -1)
                end = at + _reach(codes, at, period, 1)
                before, covered = period, end
                add(start, end - start + period, period)
        hashes = _mixed(hashes[:-scale], hashes[scale:])
        scale *= 2
    return sorted((start, length, period) for (start, length), period in found.items())


def _grouped(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Numbers for the words of several texts in a row, each text followed by a number found nowhere else, and the
    texts' starts."""
    numbers: dict[bytes, int] = {}
    parts, starts, size = [], [], 0
    for i, words in enumerate(texts):
        starts.append(size)
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        parts.append(np.array([-1 - i], np.int64))
        size += len(words) + 1
        if size >= TOGETHER or i == len(texts) - 1:
            yield np.concatenate(parts), starts
            numbers, parts, starts, size = {}, [], [], 0


def runs_of_texts(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text, given as its words."""
    out: list[list[Run]] = []
    for codes, starts in _grouped(texts):
        made: list[list[Run]] = [[] for _ in starts]
        text = 0
        for start, length, period in runs_of(codes):
            while text + 1 < len(starts) and starts[text + 1] <= start:
                text += 1
            made[text].append((start - starts[text], length, period))
        out.extend(made)
    return out


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words but those of a run that come after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length/period, of equal ones the first, then that of the smallest period."""
    # with 64 more bits the quotient is exact enough to order any two fractions of 31-bit numbers
    return min(runs, key=lambda r: (-((r[1] << 64) // r[2]), r[0], r[2])) if runs else None


RUN = "struct<start: long, length: long, period: long>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  change: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs, strongest, collapsed) per row: all runs, the one with most repeats, the text without repeats.

    Words are what stands between ASCII blanks. ``change`` may replace a row's words before the search, given its id.
    A null, empty or blank text has no words, no runs and an empty collapsed text; strongest is null without runs. Runs
    may overlap; a word goes if any run holds it behind its first period; kept words are joined by one blank. Null and
    repeated ids and repeated rows are rows like any other, other columns are ignored, an empty table gives an empty
    result. Whole texts are searched: memory in a task is that of 512 texts, time per text grows as its words times the
    logarithm of their number.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0)
        texts = [t.split() if t else [] for t in batch.column(1).cast(pa.binary()).to_pylist()]  # bytes: six ASCII blanks
        if change is not None:
            texts = [change(i, words) for i, words in zip(ids.to_pylist(), texts)]
        runs = runs_of_texts(texts)
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        shown = lambda r: None if r is None else dict(zip(("start", "length", "period"), r))
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(t) for t in texts], pa.int64()),
            pa.array([[shown(r) for r in found] for found in runs], pa.list_(kind)),
            pa.array([shown(strongest(found)) for found in runs], kind),
            pa.array([b" ".join(collapsed(t, r)) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
        ], names=[id_col, "n_words", "runs", "strongest", "collapsed"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {dict(rows.dtypes)[id_col]}, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string"
    return map_arrow(rows, run, schema)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a run in every tenth document, by the rule of op13's contract; a null id changes nothing."""
    import zlib

    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    passage = words[start:start + period]
    times = -(-(n - start) // period)
    return words[:start] + (passage * times)[:n - start]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs: their number, the strongest, digests of all and of the text without repeats."""
    found = periodic_runs(read(spark, sf_dir, "documents"), change=planted)
    best = F.col("strongest")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
