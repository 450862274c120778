"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are four segments of 16 on a ring. If two fingerprints differ in at most 3 bits, then from some
segment on, every chain of l consecutive segments differs in at most l * 3/4 bits in total: 0, 1, 2, 3 for l = 1..4.
The first two links of that chain are the key of the candidate search (one segment equal, the next at most one bit
apart: a key per start for what is looked up, 17 for what looks up); the third is checked on the candidates, and only
what is left gets the full Hamming check. With eight segments of 8 bits the same holds for up to 7 bits: a chain of l
differs in at most l * 7/8 bits, again 0 and 1 for the links that are the key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import give_back_memory, keep_table, map_arrow, read
from inkwell.llm.components import components

SEED = 42
MOST_BITS = 3
SEGMENTS = 4
BLOCK = 8192  # fingerprints of one key that are compared in one task
PAIRS = 1 << 20  # pairs that are compared at once

_BITS = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of each shingle of ``width`` words, repeats included; of the whole sequence if it is shorter."""
    # on bytes, lower() and split() know A-Z and the six ASCII blanks only, which is what words are defined by
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    count = len(words) - width + 1
    pieces = zip(starts[:count].tolist(), ends[width - 1:].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pieces), np.uint64, count)


def fingerprint(text: str | None, width: int = 3) -> int:
    """A bit is 1 if set in over half of the shingles' hashes; no words: 0."""
    return print_of(shingle_hashes(text or "", width))


def print_of(hashes: np.ndarray) -> int:
    """The fingerprint from the shingles' hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start:start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) per row, fp the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=[id_col, "fp"])

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, fp long")


def _segments(fps: np.ndarray, segments: int) -> np.ndarray:
    return fps.view(f"u{8 // segments}").reshape(-1, segments)


def chain_keys(fps: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """The looked-up keys, one per start: start, that segment and the next one, in one number."""
    s, bits = _segments(fps, segments).astype(np.int64), 64 // segments
    return np.stack([(i << 2 * bits) | (s[:, i] << bits) | s[:, (i + 1) % segments] for i in range(segments)], axis=1)


def passes_chain(a: np.ndarray, b: np.ndarray, start: np.ndarray, most_bits: int = MOST_BITS,
                 segments: int = SEGMENTS) -> np.ndarray:
    """Whether the differences along the ring from ``start`` stay within 0, 1, 2, 3 (the last is the full check); for
    other radii and rings within the whole part of link * ``most_bits`` / ``segments``."""
    apart = _segments(a ^ b, segments)
    left = np.arange(len(a))  # the pairs that have passed so far
    total = np.zeros(len(a), np.int16)
    for link in range(segments):
        total = total + _BITS[apart[left, (start[left] + link) % segments]]
        good = total <= (link + 1) * most_bits // segments
        left, total = left[good], total[good]
    passed = np.zeros(len(a), bool)
    passed[left] = True
    return passed


class Forest:
    """Components of the fingerprints seen in one partition, by whole arrays; its links are a forest."""

    def __init__(self) -> None:
        self.links = np.empty((0, 2), np.int64)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        nodes, ends = np.unique(np.concatenate([self.links[:, 0], self.links[:, 1], a, b]), return_inverse=True)
        n = len(self.links)
        u = np.concatenate([ends[:n], ends[2 * n:2 * n + len(a)]])
        v = np.concatenate([ends[n:2 * n], ends[2 * n + len(a):]])
        label = np.arange(len(nodes))
        while True:
            x, y = label[u], label[v]
            apart = x != y
            if not apart.any():
                break
            u, v, x, y = u[apart], v[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
        own = label != np.arange(len(nodes))
        self.links = np.stack([nodes[own], nodes[label[own]]], axis=1)


def _compare(key: np.ndarray, fp: np.ndarray, asks: np.ndarray, forest: Forest, most_bits: int, segments: int) -> None:
    """Adds the links of rows sorted by key; within a key, each asking row meets each looked-up one."""
    if not len(key):
        return
    order = np.lexsort((asks, key))
    key, fp, asks = key[order], fp[order], asks[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    askers = np.add.reduceat(asks.astype(np.int64), first)
    answers = size - askers
    # a row that is looked up also asks under its own key, so one of each is nothing new
    use = (answers > 0) & (askers > 1)
    first, askers, answers = first[use], askers[use], answers[use]
    ends = np.cumsum(askers * answers)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        number = np.arange(low, min(low + PAIRS, ends[-1]))
        run = np.searchsorted(ends, number, side="right")
        inside = number - (ends[run] - askers[run] * answers[run])
        b = first[run] + inside % answers[run]
        a = first[run] + answers[run] + inside // answers[run]
        new = fp[a] < fp[b]
        a, b = a[new], b[new]
        good = passes_chain(fp[a], fp[b], key[a] >> 128 // segments, most_bits, segments)
        if good.any():
            forest.add(fp[a[good]], fp[b[good]])


def near_links(classes: DataFrame, most_bits: int = MOST_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all that differ in at most ``most_bits`` bits,
    which must be fewer than the ``segments`` of the ring, 4 or 8. A link leads from a fingerprint to the least one of
    those connected with it in one task.

    Of the pairs found in one partition only a spanning forest leaves it, so the links are fewer than the rows
    however large a group of near copies is. Keys with more than ``BLOCK`` looked-up fingerprints are cut into blocks,
    and each block of those asking meets each block of those looked up as a key of its own: all pairs are still
    compared, in many tasks.
    """

    if segments not in (4, 8) or not 0 <= most_bits < segments:
        raise ValueError("a ring has 4 or 8 segments, and the radius is less than that")
    near = np.array([0] + [1 << b for b in range(64 // segments)], np.int64)

    def expand(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        exact = chain_keys(fps, segments)
        asking = (exact[:, :, None] ^ near).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([exact.reshape(-1), asking])),
             pa.array(np.concatenate([np.repeat(fps, segments), np.repeat(fps, segments * len(near))])),
             pa.array(np.concatenate([np.zeros(exact.size, bool), np.ones(len(asking), bool)]))],
            names=["key", "fp", "asks"])

    rows = map_arrow(classes.select("fp"), expand, "key long, fp long, asks boolean", rows=4096)
    hot = (
        map_arrow(classes.select("fp"), lambda b: pa.RecordBatch.from_arrays(
            [pa.array(chain_keys(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), segments).reshape(-1))], names=["key"]),
            "key long", rows=4096)
        .groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
        .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    hot = keep_table(hot, "hot-keys")
    if hot.isEmpty():
        dealt = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
        dealt = (
            rows.join(hot, "key", "left").withColumn("other", other)
            .withColumn("part", F.when(F.col("blocks").isNull(), F.lit(0))
                        .when(F.col("asks"), mine * F.col("blocks") + F.col("other"))
                        .otherwise(F.col("other") * F.col("blocks") + mine).cast("long"))
            .select("key", "fp", "asks", "part")
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from linked(batches)
        give_back_memory()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        held: list[tuple[np.ndarray, ...]] = []  # rows of the last key, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            held.append(tuple(columns))
            key, part = columns[0], columns[3]
            if key[0] == key[-1] and part[0] == part[-1]:
                continue
            key, fp, asks, part = (np.concatenate(c) for c in zip(*held))
            last = (key == key[-1]) & (part == part[-1])
            _by_part(key[~last], fp[~last], asks[~last], part[~last], forest, most_bits, segments)
            held = [(key[last], fp[last], asks[last], part[last])]
        if held:
            _by_part(*(np.concatenate(c) for c in zip(*held)), forest, most_bits, segments)
        for start in range(0, len(forest.links), 1 << 16):
            part = forest.links[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])

    gathered = dealt.repartition("key", "part").sortWithinPartitions("key", "part")
    return gathered.mapInArrow(compare, "a long, b long")


def _by_part(key, fp, asks, part, forest: Forest, most_bits: int, segments: int) -> None:
    if not part.any():
        _compare(key, fp, asks, forest, most_bits, segments)
        return
    for p in np.unique(part):
        at = part == p
        _compare(key[at], fp[at], asks[at], forest, most_bits, segments)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp, component_id) per row: rows linked by at most 3 differing bits share the smallest id of their group.

    Null and empty texts, and texts of blanks, have the fingerprint 0 and link like any other. Repeated rows stay
    rows; a null id belongs to its group but does not name it (a group of null ids alone has a null component). An
    empty table gives an empty result, other columns are ignored. Texts are hashed whole, whatever their length.
    """
    prints = keep_table(fingerprints(docs, id_col, text_col, width), "fingerprints")
    classes = keep_table(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    labels = components(near_links(classes))
    named = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    groups = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(groups, "label").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id. Rows with a null id stay.

    Goes by id: repeated rows of the smallest id all stay, and an id that is gone is gone with all its rows. One row
    per group, whatever the ids: :func:`inkwell.llm.near_copies.without_near_copies`.
    """
    found = near_duplicates(docs, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
