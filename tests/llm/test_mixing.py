from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import SMALL, none, odd
from compare import connect, differences
from inkwell.llm import mixing
from inkwell.llm.queries import ORACLES, QUERIES


def shares(spark, given):
    return spark.createDataFrame([*given.items()], "source_key string, share int")


def test_query_equals_its_sql(spark):
    df = QUERIES["op10_mix_sources"](spark, SMALL)
    assert differences(df, connect(SMALL), ORACLES["op10_mix_sources"]) == []
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("given", [
    {"a": 1}, {"a": 1, "b": 1}, {"a": 50, "b": 30, "c": 19, "d": 1}, {"a": 7, "b": 11, "c": 13, "d": 17, "e": 2},
    {f"s{i}": 1 + i * i % 23 for i in range(30)},
])
def test_no_source_is_ever_a_block_away_from_its_share(spark, given):
    rows = sorted(mixing.period_of(shares(spark, given)).collect(), key=lambda r: r["turn_slot"])
    total = sum(given.values())
    assert [r["turn_slot"] for r in rows] == list(range(total))
    done = Counter()
    for r in rows:
        assert r["turn"] == done[r["source_key"]]
        done[r["source_key"]] += 1
        for source, share in given.items():
            assert abs(done[source] * total - share * (r["turn_slot"] + 1)) < total
    assert done == given


def test_prefixes_have_the_target_weights(spark):
    rows = [(i, "a" if i < 900 else "b", "mine") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, mix_slot string")
    mixed = mixing.mix(docs, shares(spark, {"s:a": 3, "s:b": 1}), block_rows=10)
    assert mixed.columns == ["doc_id", "source", "mix_share", "mix_period", "mix_position", "mix_block", "mix_slot", "mix_offset"]
    order = [r["source"] for r in mixing.in_mix_order(mixed).collect()]
    assert len(order) == 1200
    for end in range(40, 1200, 40):
        assert abs(order[:end].count("a") - 0.75 * end) < 10
    again = mixing.mix(docs, shares(spark, {"s:a": 3, "s:b": 1}), block_rows=10).collect()
    assert sorted(again) == sorted(mixed.collect())


def test_odd_rows_and_none(spark):
    rows = mixing.mix(odd(spark, "mix_slot", "share"), block_rows=2).collect()
    assert len(rows) == 9 and all(r["mix_slot"] is not None for r in rows)
    places = [(r["source"], r["mix_position"]) for r in rows]
    assert sorted(places, key=repr) == sorted([("a", i) for i in range(4)] + [("b", i) for i in range(3)] + [(None, 0), (None, 1)], key=repr)
    assert mixing.mix(none(spark)).count() == 0


def test_sources_without_a_share_take_no_part(spark):
    rows = mixing.mix(odd(spark), shares(spark, {"s:a": 1, "s:b": 0, "s:zzz": 2}), block_rows=1).collect()
    assert all((r["mix_slot"] is not None) == (r["source"] == "a") for r in rows) and len(rows) == 9


def test_period_is_bounded(spark):
    with pytest.raises(Exception, match="largest period"):
        mixing.period_of(shares(spark, {"a": mixing.MAX_PERIOD, "b": 1})).collect()


def test_by_halves_weights_follow_the_roots_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_PER_GROUP", 8)
    given = {f"s:{i}": 1 + i % 40 for i in range(400)} | {"s:big": 9000, "s:small": 1}
    total = sum(given.values())
    rows = mixing.ways(shares(spark, given)).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("share") - 1)))
    turns = sorted((r["slot"], r["source_key"]) for r in rows.select("source_key", mixing.slot_by_halves("n", "way").alias("slot")).collect())
    assert [t for t, _ in turns] == list(range(total))
    bound = {}  # a node is off by less than one of its turns, and by its part of what the node above is off
    for r in mixing.ways(shares(spark, given)).collect():
        bound[r["source_key"]] = 0
        for p in reversed(r["way"]):
            bound[r["source_key"]] = 1 + p["own"] / p["whole"] * bound[r["source_key"]]
    done, off = Counter(), Counter()
    for slot, source in turns:
        off[source] = max(off[source], abs(done[source] - given[source] * slot / total))
        done[source] += 1
        off[source] = max(off[source], abs(done[source] - given[source] * (slot + 1) / total))
    assert done == given and all(off[s] < bound[s] for s in given)
    assert max(bound[s] for s in given if s != "s:big") < 4 and bound["s:big"] < 10
    later = rows.where("n = 0").select("source_key", mixing.slot_by_halves("3 * share", "way").alias("slot")).collect()
    assert all(r["slot"] // total == 3 for r in later)


def test_more_shares_than_a_period_holds_still_give_slots(spark):
    rows = [(i, "a" if i < 60 else "b") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    mixed = mixing.mix(docs, shares(spark, {"s:a": mixing.MAX_PERIOD, "s:b": 1}), block_rows=1).collect()
    assert len({r["mix_slot"] for r in mixed}) == 120 and all(r["mix_slot"] is not None for r in mixed)


def test_shares_of_sources_above_and_below_the_average_differ_in_the_pipeline(spark):
    rows = [(i * 16 + k, f"host{i}") for i in range(1200) for k in range(9 if i % 10 == 0 else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    mixed = mixing.mix(docs, by_halves=True, block_rows=1).collect()
    assert len({r["mix_slot"] for r in mixed}) == len(rows)
    assert {(int(r["source"][4:]) % 10 == 0, r["mix_share"]) for r in mixed} == {(True, 3000), (False, 1000)}
    assert "Python" not in mixing.mix(docs, by_halves=True)._jdf.queryExecution().executedPlan().toString().replace("ExistingRDD", "")
