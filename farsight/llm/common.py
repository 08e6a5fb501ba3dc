"""Helpers that the corpus operators share: row keys, tables cut from their lineage, sized joins, ranks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farsight.session import CLEANUP_SETTING, fresh_folder, shuffles_deleted  # noqa: F401

#: A join side is broadcast up to this many bytes, measured; beyond, both sides are shuffled.
MAX_BROADCAST_BYTES = 16 << 20
#: A table whose rows are known to be few is written in files of so many: a file costs a task more than these rows.
FILE_ROWS = 4096


def fresh_name(wanted: str, taken: Iterable[str]) -> str:
    """`wanted`, lengthened until no column has that name (names are compared without case)."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def saved(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The rows as written to, and read from, a new table in the shared folder: lineage ends here."""
    folder = fresh_folder(df.sparkSession, purpose)
    written(df, folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def written(df: DataFrame, folder: str, *partitioned: str, compression: str | None = None) -> None:
    """Writes the rows; what was shuffled for them goes from the disks as soon as they are written."""
    with shuffles_deleted(df.sparkSession):
        df.write.partitionBy(*partitioned).parquet(folder, compression=compression)


class Tables:
    """Tables of one job in the shared folder: `save` gives one that goes when the job is over, `keep` one that stays.

    A kept table may come from saved ones, as it is written before they go.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []
        self.latest: dict[str, str] = {}
        self.shared: list = []

    def share(self, value):
        """A broadcast of a value of bounded size, let go when the job is over."""
        self.shared.append(self.spark.sparkContext.broadcast(value))
        return self.shared[-1]

    def folder(self, purpose: str) -> str:
        """A new folder that goes when the job is over."""
        self.folders.append(fresh_folder(self.spark, purpose))
        return self.folders[-1]

    def save(self, df: DataFrame, purpose: str, *partitioned: str, compression: str | None = None) -> DataFrame:
        folder = self.folder(purpose)
        written(df, folder, *partitioned, compression=compression)
        return self.spark.read.schema(df.schema).parquet(folder)

    def renew(self, df: DataFrame, purpose: str) -> DataFrame:
        """The next state of a table: written from, among others, the state before, which then goes."""
        table = self.save(df, purpose)
        old, self.latest[purpose] = self.latest.get(purpose), self.folders[-1]
        if old is not None:
            remove(self.spark, old)
            self.folders.remove(old)
        return table

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        return saved(df, purpose)

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *failure) -> None:
        for folder in self.folders:
            remove(self.spark, folder)
        for value in self.shared:
            value.destroy()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that this job has made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, id_col: str, row: str) -> DataFrame:
    """Adds `row`, a value that no two rows share and that is the same at each evaluation.

    That is the id itself where ids are unique and not null; else the rows are written once with a number each.
    """
    found = docs.agg(
        F.count(F.lit(1)).alias("rows"), F.count(id_col).alias("ids"), F.count_distinct(id_col).alias("different")
    ).first()
    if found["rows"] == found["ids"] == found["different"] and dict(docs.dtypes)[id_col] in ("bigint", "int"):
        return docs.withColumn(row, F.col(id_col).cast("long"))
    return saved(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")


def broadcast_if_small(table: DataFrame, row_bytes: Column | int) -> DataFrame:
    """`table`, which has been saved, marked for broadcast if its measured size is within the bound."""
    each = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    size = table.agg(F.sum(each.cast("long"))).first()[0] or 0
    return F.broadcast(table) if size <= MAX_BROADCAST_BYTES else table


def in_few_files(df: DataFrame, rows: int, file_rows: int = FILE_ROWS) -> DataFrame:
    """`df`, which has `rows` rows at most, in no more partitions than these fill; where they fill more than there are, as it is."""
    return df.coalesce(max(1, -(-rows // file_rows)))


def ranked(df: DataFrame, order: Column, rank: str) -> DataFrame:
    """Adds each row's rank from 0 in the total order, without bringing the rows to one task.

    Rows are sorted in range partitions; only the number of rows of each partition goes to the driver.
    """
    part, place = fresh_name("part", df.columns), fresh_name("place", df.columns)
    parts = saved(
        df.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn(part, F.spark_partition_id())
        .withColumn(place, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)),
        "ranked",
    )
    before, starts = 0, []
    for number, rows in sorted(parts.groupBy(part).count().collect()):
        starts.append((number, before))
        before += rows
    offsets = df.sparkSession.createDataFrame(starts, f"{part} int, {rank} long")
    joined = parts.join(F.broadcast(offsets), part)
    return joined.select(*df.columns, (F.col(rank) + F.col(place)).alias(rank))


def made_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Adds costly columns so that each is worked out once a row: they come out of a generator, into which the optimizer
    copies neither what later filters and projections ask of them nor, being an outer one, a filter of its own."""
    return df.select("*", F.inline_outer(F.array(F.struct(*columns))))


def text_size(text: Column) -> Column:
    """Number of words (runs without ASCII white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
