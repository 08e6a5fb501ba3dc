"""Dealing rows to tasks at equal sums of a cost, where rows cost very different amounts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs are summed by the first so many hex digits of the point id, at most 65,536 cells whatever the number of rows.
CELL_DIGITS = 4
#: A task is dealt about so many bytes of text, or less where there are more tasks than that.
TASK_BYTES = 32 * 1024 * 1024
#: A row costs at least so many bytes.
ROW_BYTES = 256


def text_cost(text: Column) -> Column:
    """What a text costs: its bytes and something for the row; NULL counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(ROW_BYTES)


def cell_of(point: Column) -> Column:
    return F.substring(point, 1, CELL_DIGITS)


def cell_costs(rows: DataFrame, cost: str) -> DataFrame:
    """(cell, cost) of rows with a point_id: the histogram, by place, from which tasks are cut. Summed inside each task first."""
    return rows.groupBy(cell_of(F.col("point_id")).alias("cell")).agg(F.sum(cost).alias("cost"))


def cut_cells(costs: DataFrame, tasks: int) -> DataFrame:
    """(cell, part): cells in order, cut where the sum of their costs passes each of `tasks` equal shares.

    A cell goes to the share that its middle lies in, so a part holds at most its share and one more cell's cost. The one
    window runs over cells, of which there are at most 16 ** CELL_DIGITS.
    """
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("cost").over(before), F.lit(0)) + F.col("cost") / 2
    share = F.floor(middle * tasks / F.sum("cost").over(Window.partitionBy()))
    return costs.select("cell", F.least(share, F.lit(tasks - 1)).cast("int").alias("part"))


def deal_by_cost(rows: DataFrame, costs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (with point_id) dealt to tasks by the costs of their cells (`cell_costs`), and the number of tasks.

    Parts are runs of cells, hence of shards too: a task writes to few folders. Rows of cells that the costs do not name
    go to the first part. The sums are collected once to size the tasks; what is broadcast has one short row a cell.
    """
    spark = rows.sparkSession
    total = costs.agg(F.sum("cost")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    parts = F.broadcast(cut_cells(costs, tasks))
    placed = rows.withColumn("cell", cell_of(F.col("point_id"))).join(parts, "cell", "left").drop("cell")
    placed = placed.withColumn("part", F.coalesce("part", F.lit(0)))
    return placed.repartitionById(tasks, "part"), tasks
