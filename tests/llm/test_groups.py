"""Groups found bucket by bucket: the same as from all pairs, and in few rounds where a bucket has one large group."""

import random

import pytest
from pyspark.sql import functions as F

from farsight.llm import groups
from farsight.llm.common import Tables


def grouped(spark, members, linked):
    """{node: root} and the pairs that each round asked about."""
    rounds = []
    links = spark.createDataFrame(sorted(linked), "a long, b long")

    def verify(pairs, own):
        rounds.append({tuple(row) for row in pairs.select("a", "b").collect()})
        return own.save(pairs.join(links, ["a", "b"]), "links")

    with Tables(spark) as tables:
        table = tables.save(spark.createDataFrame(members, "bucket long, node long"), "members")
        roots = groups.linked_groups(table, lambda a, b: F.lit(True), verify, tables)
        return {row["node"]: row["root"] for row in roots.collect()}, rounds


def test_a_bucket_of_one_large_group_is_done_by_those_outside(spark, monkeypatch):
    monkeypatch.setattr(groups, "HUBS", (1, 2, 3))
    linked = {(0, k) for k in range(1, 15)} | {(14, 15)}
    roots, rounds = grouped(spark, [(7, k) for k in range(20)], linked)
    assert len(rounds) == 3
    assert roots == {k: 0 for k in range(16)}
    assert sum(map(len, rounds)) == len(set().union(*rounds))  # no pair twice


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(groups, "HUBS", (1, 2, 3))
    rng = random.Random(seed)
    members = sorted({(b, rng.randrange(40)) for b in range(4) for _ in range(25)})
    pairs = sorted({(x, y) for b, x in members for c, y in members if b == c and x < y})
    linked = {p for p in pairs if rng.random() < 0.05}
    # links that share no bucket are not looked for
    roots, rounds = grouped(spark, members, linked | {(100, 101)})
    wanted = {k: k for pair in linked for k in pair}
    while any(wanted[a] != wanted[b] for a, b in linked):
        for a, b in linked:
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    assert roots == wanted
    assert set().union(*rounds) <= set(pairs)


def test_a_small_table_is_written_in_few_files(spark):
    with Tables(spark) as tables:
        spread = spark.range(50).repartition(40)
        links = tables.save(spread.select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")), "links")
        roots = groups.components(links, tables, 50)
        assert roots.select("root").distinct().collect() == [(0,)] and roots.count() == 51
        assert len(roots.inputFiles()) == 1
