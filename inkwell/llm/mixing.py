"""Mixing sources to target weights by Pfair scheduling. [native: DataFrame functions only]

Each source is a task whose blocks of rows are unit jobs. With share ``w`` of a period of ``W`` slots, block ``k`` may
not start before slot floor(k*W/w) and must be placed by slot ceil((k+1)*W/w). Earliest deadline first over these
windows keeps every source within one block of its target at every slot, as long as the source has blocks left.
Shares are whole numbers, so the schedule repeats after W slots: one period is computed, in a single small row, and
all blocks find their slot by a lookup.

That row holds all sources and the shares are coarse, so any number of sources is mixed by halves instead: sources are
the leaves of a binary tree, and each inner node deals its turns to two sides in the proportion of their weights. The
turn of a side has a closed form, so a block finds its slot from the weights on the way to the root, and no schedule
is computed at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from inkwell.llm.common import bits_for, read

MAX_PERIOD = 100_000
ROWS_PER_BUCKET = 4096
SOURCES_PER_GROUP = 512  # about as many leaves of a tree are in one row


def period_of(shares: DataFrame) -> DataFrame:
    """The schedule of one period: (source_key, share, period, turn, turn_slot), a row for each of a source's turns.

    ``shares`` has (source_key, share): one row per source, share a whole number; shares below 1 or null are left out.
    The sum of shares is the period and may not exceed ``MAX_PERIOD``: it bounds the only row that holds all sources.
    """
    one = (
        shares.where("share > 0")
        .agg(F.sort_array(F.collect_list(F.struct("source_key", F.col("share").cast("long").alias("share")))).alias("s"))
        .withColumn("w", F.coalesce(F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["share"]), F.lit(0)))
        .where("w > 0")
    )
    bounded = F.when(F.col("w") <= MAX_PERIOD, F.col("w")).otherwise(
        F.raise_error(F.concat(F.lit("sum of shares above the largest period: "), F.col("w").cast("string"))).cast("long")
    )
    one = one.withColumn("w", bounded)
    zeros = F.transform("s", lambda x: F.lit(0).cast("long"))
    # state: turns done by each source, sources placed so far (positions in the sorted list)
    start = F.struct(zeros.alias("done"), F.array().cast("array<int>").alias("placed"))

    def place(state: Column, slot: Column) -> Column:
        jobs = F.transform(
            F.sequence(F.lit(0), F.size("s") - 1),
            lambda i: F.struct(
                F.ceil((state["done"][i] + 1) * F.col("w") / F.col("s")[i]["share"]).alias("deadline"),
                i.alias("at"),
                (F.floor(state["done"][i] * F.col("w") / F.col("s")[i]["share"]) <= slot).alias("released"),
            ),
        )
        first = F.array_min(F.filter(jobs, lambda j: j["released"]))["at"]
        done = F.transform(state["done"], lambda n, i: F.when(i == first, n + 1).otherwise(n))
        return F.struct(done.alias("done"), F.concat(state["placed"], F.array(first)).alias("placed"))

    slots = F.sequence(F.lit(0).cast("long"), F.col("w") - 1)
    placed = one.select("s", "w", F.aggregate(slots, start, place, lambda state: state["placed"]).alias("placed"))
    rows = placed.select("s", "w", F.posexplode("placed").alias("turn_slot", "at"))
    rows = rows.select(
        F.col("s")[F.col("at")]["source_key"].alias("source_key"), F.col("s")[F.col("at")]["share"].alias("share"),
        F.col("w").alias("period"), "turn_slot",
    )
    order = Window.partitionBy("source_key").orderBy("turn_slot")
    return rows.withColumn("turn", F.row_number().over(order) - 1)


def tempered_shares(counts: DataFrame, period: int = 1000) -> DataFrame:
    """Shares in proportion to the square root of each source's rows, about ``period`` in all, at least 1 each.

    ``counts``: (source_key, rows). Only whole numbers are compared, so any engine gets the same shares.
    """
    roots = counts.select("source_key", F.floor(F.sqrt(F.col("rows") * 1e6)).alias("root"))
    total = roots.agg(F.sum("root").alias("total"))
    share = F.greatest(F.lit(1).cast("long"), F.expr(f"root * {int(period)} div total"))
    return roots.join(F.broadcast(total)).select("source_key", share.alias("share"))


def root_weights(counts: DataFrame) -> DataFrame:
    """Weights in proportion to the square root of each source's rows, to a thousandth of the root of one row."""
    return counts.select("source_key", F.floor(F.sqrt(F.col("rows") * 1e6)).alias("share"))


_WAY = """filter(transform(if(size(s) > 1, sequence(0, cast(ceil(log2(size(s))) as int) - 1), cast(array() as array<int>)), l ->
  named_struct(
    'own', sums[least(size(s), shiftleft(shiftright(at, l) + 1, l))] - sums[shiftleft(shiftright(at, l), l)],
    'whole', sums[least(size(s), shiftleft(shiftright(at, l + 1) + 1, l + 1))] - sums[shiftleft(shiftright(at, l + 1), l + 1)],
    'left', shiftright(at, l) % 2 = 0)), p -> p.own < p.whole)"""


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Each group of ``nodes`` (node, share, group) as a tree: (node, share, group, total, way to its root)."""
    lists = nodes.groupBy("group").agg(F.sort_array(F.collect_list(F.struct((-F.col("share")).alias("less"), "node"))).alias("s"))
    zero = F.array(F.lit(0).cast("long"))
    sums = F.aggregate("s", zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) - x["less"])))
    rows = lists.withColumn("sums", sums).select("group", "s", "sums", F.posexplode("s").alias("at", "x"))
    return rows.select(F.col("x.node").alias("node"), (-F.col("x.less")).alias("share"), "group",
                       F.element_at("sums", -1).alias("total"), F.expr(_WAY).alias("way"))


def ways(shares: DataFrame) -> DataFrame:
    """(source_key, share, period, way): ``way`` has the weights of a side and of both, from the source to the root.

    ``shares`` as for :func:`period_of`, of any number and sum below 2^63. Sources are dealt to groups by the hash of
    their key, groups to groups of groups; a row holds one group's weights, about ``SOURCES_PER_GROUP``.
    """
    shares = shares.where("share > 0").select("source_key", F.col("share").cast("long").alias("share"))
    bits, step = bits_for(shares.count(), SOURCES_PER_GROUP), SOURCES_PER_GROUP.bit_length() - 1
    group = F.shiftright(F.conv(F.substring(F.md5("source_key"), 1, 6), 16, 10).cast("int"), 24 - bits)
    made = _subtrees(shares.select(F.col("source_key").alias("node"), "share", group.alias("group")))
    made = made.withColumnRenamed("node", "source_key")
    while bits > 0:
        bits -= step
        above = F.shiftright("node", step) if bits > 0 else F.lit(0)
        groups = made.groupBy("group").agg(F.max("total").alias("share")).select(F.col("group").alias("node"), "share", above.alias("group"))
        groups = _subtrees(groups).select(F.col("node").alias("group"), F.col("group").alias("next"), F.col("total").alias("all"),
                                          F.col("way").alias("rest"))
        made = made.join(groups, "group").select(
            "source_key", "share", F.col("next").alias("group"), F.col("all").alias("total"), F.concat("way", "rest").alias("way"))
    return made.select("source_key", "share", F.col("total").alias("period"), "way")


def slot_by_halves(block: str, way: str) -> Column:
    """The slot of a source's block. Of a node's turns the left side's n-th is floor(n * whole / own); the others are
    the right side's, whose n-th is ceil((n + 1) * whole / own) - 1."""
    return F.expr(f"""aggregate({way}, cast({block} as bigint), (n, p) -> if(p.left,
      (n div p.own) * p.whole + (cast(n % p.own as decimal(19, 0)) * cast(p.whole as decimal(19, 0))) div cast(p.own as decimal(19, 0)),
      ((n + 1) div p.own) * p.whole + (cast((n + 1) % p.own as decimal(19, 0)) * cast(p.whole as decimal(19, 0))
        + cast(p.own - 1 as decimal(19, 0))) div cast(p.own as decimal(19, 0)) - 1))""")


def source_key(column: str = "source") -> Column:
    """Text by which sources are told apart; a null source is a source of its own."""
    return F.coalesce(F.concat(F.lit("s:"), F.col(column).cast("string")), F.lit("null"))


def mix(docs: DataFrame, shares: DataFrame | None = None, *, block_rows: int = 64, period: int = 1000,
        id_col: str = "doc_id", source_col: str = "source", by_halves: bool = False) -> DataFrame:
    """All rows of ``docs`` with their place in the mix; sorting by (mix_slot, mix_offset) interleaves the sources.

    Adds ``mix_share`` and ``mix_period`` (the source's share of the period's slots), ``mix_position`` (in the source,
    from 0, in the order of md5(id)), ``mix_block``, ``mix_slot``, ``mix_offset`` (within the block).
    ``shares``: (source_key, share), see :func:`source_key`; by default :func:`tempered_shares` of the sources' rows.

    Every row is kept. A source that runs out leaves its later slots empty, so a prefix of the mix has the target
    weights until the first source ends, and what the larger ones have left follows in the same rhythm. Rows of a
    source without a share get null slots: they take no part. Null ids sort as '', repeated rows and ids count as
    rows of their own (which of them comes first is open only where they are equal in the id), an empty table gives
    an empty result. Columns of the input that have names of added ones are replaced.

    ``by_halves`` mixes by :func:`ways` instead of a period: the weights are :func:`root_weights`, unrounded, or
    ``shares``; ``mix_period`` is their sum. It is also taken where the sum of shares exceeds ``MAX_PERIOD``, which a
    schedule of one period cannot hold. A node's turns are dealt within one turn of the proportion, and what a source
    is off is the sum of what its nodes are off, each times the source's part of that node.

    A source's rows are numbered without gathering it: rows are counted by source and hash range, and only rows of
    one range (some thousands) are ordered in a window.
    """
    added = ["mix_share", "mix_period", "mix_position", "mix_block", "mix_slot", "mix_offset"]
    docs = docs.drop(*added, "mix_source_", "mix_hash_", "mix_bucket_")
    bits = bits_for(docs.count(), ROWS_PER_BUCKET)
    hashed = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = (
        docs.withColumn("mix_source_", source_key(source_col))
        .withColumn("mix_hash_", hashed)
        .withColumn("mix_bucket_", F.shiftright(F.conv(F.substring("mix_hash_", 1, 6), 16, 10).cast("int"), 24 - bits))
    )
    ranges = rows.groupBy("mix_source_", "mix_bucket_").agg(F.count(F.lit(1)).alias("rows"))
    if shares is None:
        counts = ranges.groupBy(F.col("mix_source_").alias("source_key")).agg(F.sum("rows").alias("rows"))
        shares = root_weights(counts) if by_halves else tempered_shares(counts, period)
    if not by_halves:
        by_halves = (shares.where("share > 0").agg(F.sum(F.col("share").cast("long"))).first()[0] or 0) > MAX_PERIOD
    earlier = Window.partitionBy("mix_source_").orderBy("mix_bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("mix_source_", "mix_bucket_", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before_"))
    within = Window.partitionBy("mix_source_", "mix_bucket_").orderBy("mix_hash_", id_col)
    if by_halves:
        # a way goes to each range of a source, of which there are few, and with the ranges to the rows
        own = ways(shares).select(F.col("source_key").alias("mix_source_"), F.col("share").alias("mix_share"),
                                  F.col("period").alias("mix_period"), F.col("way").alias("way_"))
        offsets = offsets.join(own, "mix_source_", "left")
    placed = rows.withColumn("at_", F.row_number().over(within) - 1).join(offsets, ["mix_source_", "mix_bucket_"])
    placed = (
        placed.withColumn("mix_position", F.col("before_") + F.col("at_"))
        .withColumn("mix_block", F.expr(f"mix_position div {int(block_rows)}"))
        .withColumn("mix_offset", F.col("mix_position") % block_rows)
    )
    if by_halves:
        return placed.withColumn("mix_slot", slot_by_halves("mix_block", "way_")).select(*docs.columns, *added)
    turns = period_of(shares)
    totals = turns.groupBy(F.col("source_key").alias("mix_source_"), F.col("share").alias("mix_share"),
                           F.col("period").alias("mix_period")).agg(F.count(F.lit(1)).alias("turns_")).drop("turns_")
    slots = turns.select(F.col("source_key").alias("mix_source_"), F.col("turn").alias("turn_"), "turn_slot")
    return (
        # both sides have at most MAX_PERIOD rows, which period_of enforces
        placed.join(F.broadcast(totals), "mix_source_", "left")
        .withColumn("turn_", (F.col("mix_block") % F.col("mix_share")).cast("int"))
        .join(F.broadcast(slots), ["mix_source_", "turn_"], "left")
        .withColumn("mix_slot", F.expr("mix_block div mix_share") * F.col("mix_period") + F.col("turn_slot"))
        .select(*docs.columns, *added)
    )


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """Rows dealt to partitions by their place in the mix and sorted there, unscheduled rows last."""
    order = [F.col("mix_slot").asc_nulls_last(), F.col("mix_offset")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mix whose weights are the square roots of the sources' sizes."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("doc_id", "source", "mix_share", "mix_period", "mix_position", "mix_block", "mix_slot", "mix_offset")


OP10_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE 's:' || source END AS k FROM documents
), roots AS (
  SELECT k, CAST(floor(sqrt(count(*) * 1e6)) AS BIGINT) AS r FROM docs GROUP BY k
), shares AS (
  SELECT k, greatest(1, CAST((r * 1000) // (SELECT sum(r) FROM roots) AS BIGINT)) AS s FROM roots
), p AS (
  SELECT list(k ORDER BY k) AS ks, list(s ORDER BY k) AS ss, CAST(sum(s) AS BIGINT) AS w FROM shares
), edf AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(ss, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS pick FROM p
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, i: x + CASE WHEN i = m % 100000 THEN 1 ELSE 0 END), m % 100000
  FROM (
    SELECT t, done, list_min(list_transform(done, lambda x, i:
      CASE WHEN floor(x * w / ss[i]) <= t THEN CAST(ceil((x + 1) * w / ss[i]) AS BIGINT) * 100000 + i END)) AS m
    FROM edf, p WHERE t < w)
), slots AS (
  SELECT ks[pick] AS k, t - 1 AS turn_slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn
  FROM edf, p WHERE t > 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS mix_position
  FROM docs
), blocks AS (
  SELECT n.*, mix_position // 64 AS mix_block, mix_position % 64 AS mix_offset, s AS mix_share, w AS mix_period
  FROM numbered n JOIN shares USING (k), p
)
SELECT doc_id, source, mix_share, mix_period, mix_position, mix_block,
  (mix_block // mix_share) * mix_period + turn_slot AS mix_slot, mix_offset
FROM blocks b JOIN slots l ON l.k = b.k AND l.turn = b.mix_block % b.mix_share
"""
