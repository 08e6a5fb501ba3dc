"""Groups of linked nodes: connected components, and links found bucket by bucket without all pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from farsight.llm.common import MAX_BROADCAST_BYTES, Tables, broadcast_if_small, in_few_files

#: How many members of a bucket are compared with the rest of it in the first rounds, and in all later ones. Below 1,000, where
#: Spark stops to cut a bucket within map tasks before it is sorted.
HUBS = (1, 8, 512)


def _state(edges: DataFrame) -> Row:
    """How many edges there are, and what tells them from another set."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame, tables: Tables, most: int) -> DataFrame:
    """(node, root) of every node in `links` (a, b), `most` rows at most: root is the smallest node of its connected component.

    The result is the table "groups" of `tables`; `links` may be made from the one before.

    Alternates two steps until nothing changes: each node links its larger neighbours to the smallest node near it;
    then its smaller ones. Both need the smallest neighbour only, which is found within map tasks first; a node with very many
    neighbours is a skewed join key, which Spark splits. While the edges, which are counted in each turn, are few, the smallest
    neighbours are broadcast.
    """
    with Tables(links.sparkSession) as own:
        ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        edges = own.renew(in_few_files(ends.filter("u > v").distinct(), most), "edges")
        state = _state(edges)
        while True:
            small_enough = state[0] * 2 * 16 <= MAX_BROADCAST_BYTES  # a smallest neighbour for each end at most
            near = F.broadcast if small_enough else lambda table: table
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.filter("v > u").join(near(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(near(least), "u").select(
                F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")
            )
            edges = own.renew(in_few_files(small.distinct(), state[0]), "edges")
            seen = _state(edges)
            if seen == state:
                break
            state = seen
        roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
        groups = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots).distinct()
        return tables.renew(in_few_files(groups, 2 * state[0]), "groups")


def _order(side: str) -> list[Column]:
    """By which members of a bucket are chosen: those of its largest group last."""
    return [F.col(f"{side}.root").eqNullSafe(F.col(f"{side}.major")).alias("last"), F.col(f"{side}.node").alias("node")]


def linked_groups(
    members: DataFrame,
    may_link: Callable[[str, str], Column],
    verify: Callable[[DataFrame, Tables], DataFrame],
    results: Tables,
    enrich: Callable[[list[DataFrame], Tables], list[DataFrame]] | None = None,
    must_link: Callable[[str, str], Column] | None = None,
    worth: tuple[list[Column], Column] | None = None,
    details: DataFrame | None = None,
    lots: int = 1,
) -> DataFrame:
    """(node, root) of all nodes that links connect, saved in `results`; nodes are long, root is the smallest of its group.

    `members` (bucket, node, ...) says which nodes may be linked: those that share a bucket and for which `may_link`,
    given two aliases of such rows, holds; it is checked inside the join. `verify` takes the pairs (a, b) left and returns those that are
    links. The groups are those that comparing all pairs of every bucket would give, but pairs that can no longer join
    two groups are not made: in each round some members of a bucket (at first one) are compared with all
    its other members outside their group, and then leave the bucket; a bucket that lies in one group is done. So the near copies
    of one text cost a pair each. Chosen are first those outside the bucket's largest group, by number of node: once these have left,
    one group is all that remains. A bucket is never gathered in a task: its rows are one side of a join.

    `details` (node, ...) holds what `may_link` asks of a node besides: `members`, of which most share no bucket, are shuffled
    without it. With `lots` above one, buckets (numbers spread evenly) are worked on in so many lots, one after the other in each
    step of a round, so that no shuffle holds more than one lot.

    After the first round `enrich`, if given, adds columns to the few rows (bucket, node, root, ...) left on the two sides before they are joined, and
    `must_link` is also asked in the join: with what those columns hold it can decide about a pair before it becomes a
    row. What `enrich` adds is not kept from round to round, and rows without any partner do not get it.
    `worth`, aggregates over a bucket and a condition on them, says which buckets can hold a pair at all.
    What `verify` and `enrich` save in the tables they are given goes at the end of the round, and so does all that a round writes
    but the pairs tried; the small files of many tasks are read by few ones in the next round.
    """
    facts, holds = worth or ([], F.lit(True))
    with Tables(members.sparkSession) as tables:
        live = []
        for lot in range(lots):
            with Tables(members.sparkSession) as own:
                part = members if lots == 1 else members.filter(F.pmod("bucket", F.lit(lots)) == lot)
                ends = part.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), *facts)
                ends = ends.filter((F.col("low") < F.col("high")) & holds).select("bucket")
                ends = broadcast_if_small(own.save(ends, "buckets"), 16)
                part = part.join(ends, "bucket").withColumn("root", F.col("node"))
                part = part.withColumn("major", F.lit(None).cast("long"))
                if details is not None:
                    part = own.save(part, "shared").join(details, "node")
                live.append(tables.renew(part, f"live-{lot}"))
        found, tried, turn = None, None, 0
        while True:
            with Tables(members.sparkSession) as own:
                hubs = HUBS[min(turn, len(HUBS) - 1)]
                last = F.col("root").eqNullSafe(F.col("major"))
                place = F.row_number().over(W.partitionBy("bucket").orderBy(last, "node"))
                later = F.struct(*_order("l")) > F.struct(*_order("h"))
                same = (F.col("l.bucket") == F.col("h.bucket")) & later
                allowed = same & (F.col("l.root") != F.col("h.root")) & may_link("l", "h")
                compared, pairs = [], None
                for part in live:
                    chosen = own.save(part.withColumn("place", place).filter(F.col("place") <= hubs).drop("place"), "chosen")
                    chosen = broadcast_if_small(chosen, 8 * len(chosen.columns) + 16)
                    compared.append(chosen)
                    left, right, wanted = part, chosen, allowed
                    if turn and enrich is not None:  # only for rows that have any partner
                        left = own.save(part.alias("l").join(chosen.alias("h"), allowed, "left_semi"), "partners")
                        others = broadcast_if_small(left, 8 * len(left.columns) + 16)
                        right = own.save(chosen.alias("h").join(others.alias("l"), allowed, "left_semi"), "partners")
                        left, right = enrich([left, right], own)
                        wanted = allowed & must_link("l", "h")
                    near = left.alias("l").join(right.alias("h"), wanted)
                    near = near.select(F.least("h.node", "l.node").alias("a"), F.greatest("h.node", "l.node").alias("b")).distinct()
                    near = near if len(live) == 1 else own.save(near, "lot-pairs")
                    pairs = near if pairs is None else pairs.unionAll(near)
                pairs = pairs if len(live) == 1 else pairs.distinct()
                pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
                pairs = tables.save(pairs, "pairs")
                tried = pairs if tried is None else tried.unionAll(pairs)
                links, most = verify(pairs, own).select("a", "b"), pairs.count()
                if found is not None:
                    most += found.count()
                    links = links.unionAll(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
                found = components(links, tables, most)
                roots = broadcast_if_small(found, 24)
                for lot, (part, chosen) in enumerate(zip(live, compared)):
                    rest = part.drop("root", "major").join(chosen.select("bucket", "node"), ["bucket", "node"], "left_anti")
                    grouped = rest.join(roots, "node", "left").select(*rest.columns, F.coalesce("root", "node").alias("root"))
                    grouped = own.renew(grouped, "grouped")
                    mixed = grouped.groupBy("bucket", "root").count().groupBy("bucket").agg(
                        F.max(F.struct("count", "root")).alias("most"), F.count(F.lit(1)).alias("groups")
                    )
                    mixed = mixed.filter("groups > 1").select("bucket", F.col("most.root").alias("major"))
                    mixed = own.save(in_few_files(mixed, part.count() // 2), "mixed")
                    live[lot] = tables.renew(grouped.join(broadcast_if_small(mixed, 24), "bucket"), f"live-{lot}")
            if all(part.isEmpty() for part in live):
                return results.save(found, "linked-groups")
            turn += 1
