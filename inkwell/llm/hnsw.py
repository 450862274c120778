"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph for each shard, stored as
flat neighbour arrays, and the shards' results merged."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from inkwell.llm.common import keep_table, read

SHARD_ROWS = 8192  # different vectors in a shard, in the mean
QUERY_BLOCK = 4096  # queries that one task answers from one shard, in the mean
LINKS = 16  # of a node above the ground level; twice as many on it
EF_BUILD = 80
EF_SEARCH = 128


class Graph:
    """The graph over the rows of a matrix.

    Rows get one more component so that all have the same length; the nearest by distance are then those with the
    largest inner product, whatever the lengths of the vectors were.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        squares = (vectors * vectors).sum(axis=1)
        rest = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0))
        self.points = np.hstack([vectors, rest[:, None]]).astype(np.float32)
        n = len(vectors)
        self.seen = np.zeros(n, np.int64)
        self.stamp = 0
        self.levels: list[dict[int, np.ndarray]] = []
        self.entry = -1

    @staticmethod
    def build(vectors: np.ndarray) -> Graph:
        graph = Graph(vectors)
        rng = np.random.default_rng(len(vectors))
        tops = np.minimum(-np.log(1 - rng.random(len(vectors))) / math.log(LINKS), 12).astype(int)
        for node, top in enumerate(tops.tolist()):
            graph._insert(node, top)
        return graph

    def _search(self, q: np.ndarray, entries: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """Up to ``ef`` (similarity, node), in no order, found from the entries along the level's links."""
        links, points, seen = self.levels[level], self.points, self.seen
        self.stamp += 1
        stamp = self.stamp
        seen[[n for _, n in entries]] = stamp
        open_ = [(-s, n) for s, n in entries]
        heapq.heapify(open_)
        best = list(entries)
        heapq.heapify(best)
        while open_:
            s, node = heapq.heappop(open_)
            if len(best) >= ef and -s < best[0][0]:
                break
            near = links[node]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            similar = points[near] @ q
            if len(best) >= ef:
                closer = similar > best[0][0]
                near, similar = near[closer], similar[closer]
            for s, n in zip(similar.tolist(), near.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (s, n))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, n))
                else:
                    continue
                heapq.heappush(open_, (-s, n))
        return best

    def _spread(self, similar: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Links to keep: nearest first, those first that are nearer to the node than to any kept one."""
        order = np.argsort(-similar, kind="stable")
        nodes, similar = nodes[order], similar[order]
        among = self.points[nodes] @ self.points[nodes].T
        covered = np.full(len(nodes), -np.inf, np.float32)
        kept, passed = [], []
        for i in range(len(nodes)):
            if similar[i] > covered[i]:
                kept.append(i)
                if len(kept) == most:
                    break
                np.maximum(covered, among[i], out=covered)
            else:
                passed.append(i)
        return nodes[kept + passed[:most - len(kept)]]

    def _insert(self, node: int, top: int) -> None:
        point = self.points[node]
        height = len(self.levels) - 1
        while len(self.levels) <= top:
            self.levels.append({})
        if self.entry < 0:
            for level in range(top + 1):
                self.levels[level][node] = np.empty(0, np.int32)
            self.entry = node
            return
        found = [(float(self.points[self.entry] @ point), self.entry)]
        for level in range(height, top, -1):
            found = [max(self._search(point, found, 1, level))]
        for level in range(min(top, height), -1, -1):
            found = self._search(point, found, EF_BUILD, level)
            most = LINKS * (2 if level == 0 else 1)
            mine = self._spread(np.array([s for s, _ in found], np.float32), np.array([n for _, n in found], np.int32), LINKS)
            links = self.levels[level]
            links[node] = mine
            for other in mine.tolist():
                theirs = np.append(links[other], np.int32(node))
                if len(theirs) > most:
                    # thinned out below the most, so that not every new link costs a choice
                    theirs = self._spread(self.points[theirs] @ self.points[other], theirs, most * 3 // 4)
                links[other] = theirs
        for level in range(height + 1, top + 1):
            self.levels[level][node] = np.empty(0, np.int32)
        if top > height:
            self.entry = node

    def nearest(self, q: np.ndarray, k: int) -> list[int]:
        """Nodes that are likely the ``k`` nearest to a query, nearest first."""
        if self.entry < 0:
            return []
        q = np.append(q, 0).astype(np.float32)
        found = [(float(self.points[self.entry] @ q), self.entry)]
        for level in range(len(self.levels) - 1, 0, -1):
            found = [max(self._search(q, found, 1, level))]
        found = self._search(q, found, max(EF_SEARCH, 2 * k), 0)
        return [n for _, n in heapq.nlargest(k, found)]

    def flat(self) -> dict[str, np.ndarray | int]:
        """The links as flat arrays: link i goes from ``nodes[i]`` on ``level_of[i]`` to neighbours[offsets[i]:offsets[i+1]]."""
        lists = [(level, node, near) for level, links in enumerate(self.levels) for node, near in links.items()]
        sizes = np.array([len(near) for _, _, near in lists], np.int32)
        return {
            "entry": self.entry, "level_of": np.array([x for x, _, _ in lists], np.int32),
            "nodes": np.array([x for _, x, _ in lists], np.int32),
            "offsets": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
            "neighbours": np.concatenate([np.empty(0, np.int32), *[near for _, _, near in lists]]).astype(np.int32),
        }

    @staticmethod
    def load(vectors: np.ndarray, entry: int, level_of, nodes, offsets, neighbours) -> Graph:
        graph = Graph(vectors)
        graph.entry = entry
        graph.levels = [{} for _ in range(int(level_of.max(initial=-1)) + 1)]
        for i, (level, node) in enumerate(zip(level_of.tolist(), nodes.tolist())):
            graph.levels[level][node] = neighbours[offsets[i]:offsets[i + 1]]
        return graph


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, not zero, all components finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


INDEX = ("dim int, shard int, ids array<array<bigint>>, vectors array<double>, entry int, level_of array<int>, "
         "nodes array<int>, offsets array<int>, neighbours array<int>")
_IDS = pa.list_(pa.list_(pa.int64()))


def build_index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per shard: its different vectors, the ids of their rows, and the graph as flat arrays (see INDEX).

    Vectors of different lengths are in different shards. Equal vectors are one node, with the smallest k + 1 of their
    ids: as they are equally near to any query and ties go to the smaller id, no other of them can be among k results.
    Every usable vector is indexed; rows with a null id are not, as no result could name them.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    first = Window.partitionBy("v").orderBy("id")
    classes = keep_table(
        rows.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")), "vectors")
    shards = max(1, math.ceil(classes.count() / SHARD_ROWS))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        dim, shard = (x.as_py() for x in key)
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        graph = Graph.build(flat.reshape(-1, dim)).flat()
        arrays = {name: pa.array([graph[name]], pa.list_(pa.int32())) for name in ("level_of", "nodes", "offsets", "neighbours")}
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
            "ids": pa.array([table["ids"].to_pylist()], _IDS), "vectors": pa.array([flat], pa.list_(pa.float64())),
            "entry": pa.array([graph["entry"]], pa.int32()), **arrays})

    dealt = classes.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    return keep_table(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX), "index")


def search(index: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest of the index, nearest first.

    score is the inner product of the original vectors in double precision, ties go to the smaller id. A query's own
    id is no result. Queries meet only shards of vectors as long as theirs; fewer results come only if there are fewer
    candidates. Null, zero and non-finite queries give no rows, repeated queries count once, no queries give no rows.
    """
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("q"))
    asked = asked.where(F.col("query_id").isNotNull() & usable(F.col("q"))).dropDuplicates(["query_id", "q"])
    asked = asked.withColumn("dim", F.size("q"))
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    # the stated queries meet each shard in blocks; a shard is sent once for each block
    listed = index.select(F.col("dim").alias("to_dim"), F.col("shard").alias("to_shard"))
    asked = asked.join(listed, F.col("dim") == F.col("to_dim")).select("query_id", "q", "to_dim", "to_shard", F.col("block").alias("to_block"))
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(key: tuple, shard: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if shard.num_rows and asked.num_rows:
            own = {name: shard[name].combine_chunks() for name in shard.column_names}
            array = lambda name: own[name].flatten().to_numpy(zero_copy_only=False)
            vectors = array("vectors").reshape(-1, own["dim"][0].as_py())
            ids = own["ids"][0].as_py()
            graph = Graph.load(vectors, own["entry"][0].as_py(), *(array(n) for n in ("level_of", "nodes", "offsets", "neighbours")))
            for query, q in zip(asked["query_id"].to_pylist(), asked["q"]):
                q = q.values.to_numpy(zero_copy_only=False)
                nodes = graph.nearest(q, k + 1)
                scores = (vectors[nodes] * q).sum(axis=1).tolist()
                rows = [(-s, i) for s, n in zip(scores, nodes) for i in ids[n] if i != query]
                out += [(query, i, -s) for s, i in heapq.nsmallest(k, rows)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    pairs = shards.groupBy("dim", "shard", "block").cogroup(asked.groupBy("to_dim", "to_shard", "to_block"))
    found = pairs.applyInArrow(answer, "query_id long, vec_id long, score double")
    # one id may have several vectors: its best counts
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_nearest(spark: SparkSession, sf_dir: str, k: int = 20, every: int = 20) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(build_index(vectors, k), vectors.where(F.col("vec_id") % every == 0), k)
