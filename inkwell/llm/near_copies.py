"""Near copies by SimHash and the Jaccard similarity of their word shingles.

Texts with the same words are one class. Classes are linked in three waves, each with an exact check: a candidate pair
is a link if the similarity of its shingle sets is high enough.

* SimHash: fingerprints of the shingles that differ in at most ``RADIUS`` bits, all found by the pigeonring of
  ``RING`` segments (:func:`inkwell.llm.simhash.near_links`).
* What lies further apart: a similarity of 0.8 is a distance of some 10 of 64 bits, at 14 bits with nine of ten pairs
  within, which no chain of segments tells from chance. So min-hashes of a class, ``ROWS`` to a band, are its keys: two
  classes of the similarity asked for share a key in some band but for a chance of ``MISS``. Each class that SimHash has
  left apart from the least one of a key meets that one.
* At the keys where this has left classes apart, all meet. There classes are put in blocks, each block meets each, and
  within two blocks an exact filter finds the pairs worth comparing: sets that are similar enough share one of their
  rarest shingles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import give_back_memory, keep_table, map_arrow
from inkwell.llm.components import components
from inkwell.llm.simhash import SEED, near_links, print_of, shingle_hashes

RADIUS = 7  # bits in which fingerprints of candidates differ at most
RING = 8  # segments of a fingerprint
ROWS = 5
MISS = 3e-6
BLOCK = 1024  # classes of a key that meet others in one task
CHUNK = 512  # shingles that are hashed at once


def bands_for(least: float) -> int:
    """Bands of which two sets of similarity ``least`` share none with a chance of at most ``MISS``."""
    same = least ** ROWS
    return 1 if same >= 1 else math.ceil(math.log(MISS) / math.log1p(-same))


def _numbers(bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    made = np.random.default_rng(SEED).integers(0, 1 << 63, (3, bands * ROWS), dtype=np.int64).view(np.uint64)
    return made[0] * np.uint64(2) + np.uint64(1), made[1], made[2] * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray, numbers: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """A key per band from the min-hashes of the shingles; no shingles have no keys."""
    if not len(hashes):
        return np.empty(0, np.int64)
    times, plus, mix = numbers
    least = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        block = hashes[start:start + CHUNK, None] * times
        block += plus
        np.minimum(least, block.min(axis=0), out=least)
    # the factors differ between bands, so a key is of one band only
    return ((least ^ (least >> np.uint64(29))) * mix).reshape(-1, ROWS).sum(axis=1, dtype=np.uint64).view(np.int64)


def class_of(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), SEED)).astype(np.int64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets, given as arrays of distinct values."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def _alike(classes: DataFrame) -> DataFrame:
    """Candidates (a, b) among ``classes`` (class, fp) that connect all whose fingerprints differ in at most ``RADIUS`` bits;
    classes without shingles have no fingerprint."""
    prints = keep_table(classes.where("fp is not null").groupBy("fp").agg(F.min("class").alias("first")), "near-fingerprints")
    same = classes.join(prints, "fp").where("class <> first").select(F.col("first").alias("a"), F.col("class").alias("b"))
    first = prints.select(F.col("fp").alias("a"), F.col("first").alias("class_a"))
    second = prints.select(F.col("fp").alias("b"), F.col("first").alias("class_b"))
    links = near_links(prints, RADIUS, RING).distinct().join(first, "a").join(second, "b")
    links = links.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
    return same.unionByName(links)


def _linked(pairs: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) of classes whose texts (class, text) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # the shingles of classes that were met last

        def shingles(number: int, text: str) -> np.ndarray:
            if number not in held:
                if len(held) >= 32:
                    del held[next(iter(held))]
                held[number] = np.unique(shingle_hashes(text, width))
            return held[number]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = [similarity(shingles(a[i], batch.column(2)[i].as_py()), shingles(b[i], batch.column(3)[i].as_py())) >= least
                    for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
        held.clear()
        give_back_memory()

    first = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(run, "a long, b long")


class _Sets:
    """Classes of one or two blocks with their shingle sets, and which of them are connected."""

    def __init__(self, classes: np.ndarray, own: np.ndarray, block: np.ndarray, sets: list[np.ndarray]) -> None:
        self.classes, self.block, self.sets = classes, block, sets
        self.top = {int(o): int(o) for o in own}
        self.own = own.tolist()

    def find(self, label: int) -> int:
        while self.top[label] != label:
            self.top[label] = self.top[self.top[label]]
            label = self.top[label]
        return label

    def candidates(self, least: float) -> Iterator[tuple[int, int]]:
        """Pairs of rows whose sets can be similar enough: they share one of their rarest shingles.

        Of a set of n, ``least`` n must be shared; so two sets cannot miss each other in all of the n - least n + 1
        shingles that come first in an order which is the same for both, here the rarest first.
        """
        sizes = np.fromiter(map(len, self.sets), np.int64, len(self.sets))
        row = np.repeat(np.arange(len(sizes)), sizes)
        _, token, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *self.sets]), return_inverse=True, return_counts=True)
        order = np.lexsort((token, counts[token], row))
        row, token = row[order], token[order]
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # the small number keeps rounding from shortening a prefix
        first = place < (sizes - np.ceil(least * sizes - 1e-9) + 1)[row]
        row, token = row[first], token[first]
        order = np.lexsort((row, token))
        row, token = row[order], token[order]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        two = len(np.unique(self.block)) > 1
        seen: set[tuple[int, int]] = set()
        for start, end in zip(starts.tolist(), np.r_[starts[1:], len(token)].tolist()):
            if end - start < 2:
                continue
            apart: dict[int, list[int]] = {}
            for x in row[start:end].tolist():
                apart.setdefault(self.find(self.own[x]), []).append(x)
            groups = list(apart.values())
            for k, group in enumerate(groups):  # rows of one group need not meet
                for x, y in itertools.product(group, itertools.chain.from_iterable(groups[k + 1:])):
                    pair = (x, y) if x < y else (y, x)
                    if pair in seen or (two and self.block[x] == self.block[y]):
                        continue
                    seen.add(pair)
                    if min(sizes[x], sizes[y]) >= least * max(sizes[x], sizes[y]) - 1e-9:
                        yield pair

    def links(self, least: float) -> list[tuple[int, int]]:
        """Links between classes that were not connected before: a forest of those that there are."""
        made = []
        for x, y in self.candidates(least):
            u, v = self.find(self.own[x]), self.find(self.own[y])
            if u != v and similarity(self.sets[x], self.sets[y]) >= least:
                self.top[max(u, v)] = min(u, v)
                made.append((int(self.classes[x]), int(self.classes[y])))
        return made


def _met(members: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """Links (a, b) between the classes of a key that are not in one group yet; members: key, n (classes of the key), class,
    own (its group so far); texts: class, text."""

    def shingle(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [np.unique(shingle_hashes(t or "", width)).tobytes() for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["class", "shingles"])

    needed = texts.join(members.select("class").distinct(), "class", "left_semi").select("class", "text")
    sets = keep_table(map_arrow(needed, shingle, "class long, shingles binary"), "near-sets")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("class"), blocks).cast("int")
    dealt = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "class", "own")
    rows = dealt.join(sets, "class").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last two blocks, which may go on in the next batch

        def finish() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            classes, own, block = (table.column(c).to_numpy() for c in ("class", "own", "mine"))
            sets = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
            made = _Sets(classes, own, block, sets).links(least)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in made], pa.int64()) for k in (0, 1)], names=["a", "b"])

        last = None
        for batch in batches:
            parts = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
            start = 0
            for at in range(1, len(parts) + 1):
                if at < len(parts) and parts[at] == parts[start]:
                    continue
                if held and parts[start] != last:
                    yield finish()
                    held = []
                held.append(batch.slice(start, at - start))
                last, start = parts[start], at
        if held:
            yield finish()
        held = []
        give_back_memory()

    rows = rows.select("class", "key", "i", "j", "mine", "own", "shingles")
    return rows.mapInArrow(compare, "a long, b long").distinct()


def _labels(links: DataFrame) -> DataFrame:
    return keep_table(components(links).select(F.col("node").alias("class"), "label"), "near-labels")


def _with_groups(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``shared`` with the groups so far of their class (own) and of the least class of the key (head)."""
    own = labels.select(F.col("class"), F.col("label").alias("own"))
    head = labels.select(F.col("class").alias("first"), F.col("label").alias("head"))
    rows = shared.join(own, "class", "left").join(head, "first", "left")
    return rows.withColumn("own", F.coalesce("own", "class")).withColumn("head", F.coalesce("head", "first"))


def near_groups(rows: DataFrame, width: int = 5, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Classes and groups of ``rows`` (number, text): (number, class), and (class, label) of the classes with near copies.

    ``number`` tells the rows apart. Classes linked by a similarity of their ``width``-word shingles of at least
    ``least`` have the same label, the smallest class of their group; a class that is not listed is its own group. Words
    are told apart by ASCII blanks, without regard to the case of A-Z; a text of fewer words is one shingle. Null,
    empty and blank texts are one class, which is like no other. Texts are read whole, whatever their length.

    Classes are compared by 64-bit hashes of their words and shingles. A key that very many classes share is dealt to
    many tasks, ``BLOCK`` classes against as many in each; all of its pairs are looked at that nothing has connected yet.
    """
    numbers = _numbers(bands_for(least))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        fps, keys = [], []
        for text in texts:
            hashes = shingle_hashes(text, width)
            fps.append(int(np.uint64(print_of(hashes)).astype(np.int64)) if len(hashes) else None)
            keys.append(band_keys(hashes, numbers))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([class_of(t) for t in texts], pa.int64()), pa.array(fps, pa.int64()),
             pa.array(keys, pa.list_(pa.int64()))], names=["number", "class", "fp", "keys"])

    prints = keep_table(map_arrow(rows.select("number", F.col("text").cast("string").alias("text")), run,
                                  "number long, class long, fp long, keys array<long>"), "near-prints")
    firsts = keep_table(prints.groupBy("class").agg(F.min("number").alias("number"), F.min("fp").alias("fp")), "near-classes")
    alike = keep_table(_alike(firsts.select("class", "fp")), "near-alike")
    members = prints.join(firsts, ["number", "class"], "left_semi").select("class", F.explode("keys").alias("key"))
    keys = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("first")).where("n > 1")
    shared = keep_table(members.join(keys, "key"), "near-shared")
    met = shared.select("class").unionByName(alike.select(F.explode(F.array("a", "b")).alias("class")))
    met = met.distinct().join(firsts, "class")
    texts = keep_table(rows.join(met, "number").select("class", F.col("text").cast("string").alias("text")), "near-texts")

    links = keep_table(_linked(alike, texts, width, least), "near-links")
    apart = _with_groups(shared, _labels(links)).where("own <> head")
    first_wave = apart.select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    links = links.unionByName(keep_table(_linked(first_wave, texts, width, least), "near-links"))
    labels = _labels(links)
    # what these left apart, at the keys where they left something
    apart = keep_table(_with_groups(shared, labels), "near-apart")
    # the keys whose classes are not all in one group
    unsettled = apart.where("own <> head").select("key").distinct()
    again = keep_table(apart.join(unsettled, "key", "left_semi").select("key", "n", "class", "own"), "near-again")
    more = keep_table(_met(again, texts, width, least), "near-links")
    if not more.isEmpty():
        labels = _labels(links.unionByName(more))
    return prints.select("number", "class"), labels


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5,
                        least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: one row of each group of :func:`near_groups`, that with the smallest id.

    Rows are told apart by a number of their own and not by their id: of rows that repeat an id in one group one stays,
    rows with the same id in different groups do not touch each other, and a null id comes after all others, so that of
    copies without an id one stays as well. Of equal ids any one row stays. All columns are kept; an empty table gives
    an empty result.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("number"))
    rows = keep_table(rows, "near-rows")
    classes, labels = near_groups(rows.select("number", F.col("row")[text_col].alias("text")), width, least)
    ids = rows.select("number", F.col("row")[id_col].alias("id"))
    members = (
        classes.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
        .join(ids, "number").select("number", "label", F.struct(F.col("id").isNull().alias("none"), "id", "number").alias("place"))
    )
    members = keep_table(members, "near-members")
    stay = members.groupBy("label").agg(F.min("place").alias("least")).select(F.col("least.number").alias("number"))
    gone = members.select("number").join(stay, "number", "left_anti")
    return rows.join(gone, "number", "left_anti").select("row.*")
