"""From any table of ids and texts into a collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.ids import point_id
from ..functions.text import MAX_CHARS, index_tokens, text_for_embedding
from ..session import fresh_folder
from ..sources.collection import shard_of
from ..sources.embedding_cache import EmbeddingCache
from ..sources.statistics import gathered, write_statistics
from ..sources.store import CollectionStore
from .balance import cell_costs, deal_by_cost, text_cost
from .cleaning import clean, id_and_text, missing_id_counts, require_some_ids
from .embedding import BATCH_SIZE, Embedder, embed_column
from .upsert import keep_last


def ingest_summary(points: DataFrame, rows_per_point: str | None = None) -> DataFrame:
    """Rows upserted per shard; rows that were overwritten within the run count too."""
    counted = F.count(F.lit(1)) if rows_per_point is None else F.sum(rows_per_point)
    return (
        points.groupBy("shard")
        .agg(counted.cast("bigint").alias("upserted_count"))
        .select(F.conv("shard", 16, 10).cast("int").alias("partition_id"), "upserted_count")
    )


def ingest_costs(cleaned: DataFrame, max_chars: int | None, folder: str) -> DataFrame:
    """(cell, cost) of what an ingest has to embed: of each id the last row counts. Saved in `folder`, one short row a cell."""
    costs = cleaned.select("original_id", "seq", text_cost(text_for_embedding(F.col("text"), max_chars)).alias("cost"))
    last = costs.groupBy("original_id").agg(F.max(F.struct("seq", "cost"))["cost"].alias("cost"))
    placed = last.select(point_id(F.col("original_id")).alias("point_id"), "cost")
    cell_costs(placed, "cost").write.parquet(folder)
    return cleaned.sparkSession.read.schema("cell string, cost bigint").parquet(folder)


def ingest(
    store: CollectionStore,
    name: str,
    source: DataFrame,
    embedder: Embedder,
    id_col: Column | str = "id",
    text_col: Column | str = "text",
    seq_col: Column | str | None = None,
    batch_size: int = BATCH_SIZE,
    max_chars: int | None = MAX_CHARS,
    some_ids: bool = True,
    cache: EmbeddingCache | None = None,
    by_cost: bool = False,
) -> DataFrame:
    """Clean, keep the last row per id, embed, check and write; then show the new segment.

    Ids are counted first: only where some repeat are the texts shuffled to find the last row of each. Then the source is read
    once: vectors of the wrong size are counted while they are written, and the segment only becomes visible if there are none. Duplicates are dropped before the model
    is called. Returns (partition_id, upserted_count). A source none of whose rows has an id is refused, unless `some_ids`
    is false. With a `cache` the model sees only texts it has not met before; the source is then read once more. With `by_cost` tasks embed equal sums of bytes in place of equal numbers of rows: the
    source is read once more before, of which ids and lengths are moved. The first ingest into a collection that names no
    model binds it to the embedder's.
    """
    entry = store.entry(name)
    if entry["model_name"] and entry["model_name"] != embedder.model:
        raise ValueError(
            f"{name!r} holds vectors of {entry['model_name']!r}, not of {embedder.model!r}"
        )

    def column(given: Column | str | None) -> Column | None:
        return F.col(given) if isinstance(given, str) else given

    seen_vectors = Observation()
    digits = entry["shard_digits"]
    rows = id_and_text(source, column(id_col), column(text_col), column(seq_col))
    cleaned = clean(rows)
    counts = cleaned.agg(F.count("original_id").alias("rows"), F.count_distinct("original_id").alias("ids")).first()
    if counts["rows"] == counts["ids"]:
        latest = cleaned.withColumn("seen", F.lit(1).cast("long"))
    else:
        latest = keep_last(cleaned, "original_id", "seq", seen="seen")
    spread = F.pmod(F.xxhash64("point_id"), F.lit(store.writers_per_shard(entry)))
    placed = latest.withColumn("point_id", point_id(F.col("original_id"))).withColumn(
        "shard", shard_of(F.col("point_id"), digits)
    )
    tasks = 0
    if by_cost:
        placed, tasks = deal_by_cost(placed, ingest_costs(cleaned, max_chars, fresh_folder(store.spark, "costs")))
    else:
        placed = placed.repartition("shard", spread)
    placed = placed.select(
        "point_id",
        F.col("original_id").alias("id"),
        "text",
        "seen",
        "shard",
        text_for_embedding(F.col("text"), max_chars).alias("model_text"),
        *(["part"] if by_cost else []),
    )
    if cache is None:
        embedded = embed_column(placed, "model_text", embedder, batch_size)
    else:
        embedded = cache.embed(placed, "model_text", embedder, entry["vector_size"], batch_size)
        # The join by text has dealt the rows anew; files want them by shard.
        embedded = embedded.repartitionById(tasks, "part") if by_cost else embedded.repartition("shard", spread)
    points = (
        embedded.observe(
            seen_vectors,
            *gathered(entry["vector_size"]),
        )
        .withColumn("tokens", index_tokens(F.col("text")))
    )
    segment, path = store.new_segment(entry)
    store.write_points(points, path)

    if store.read_segment(path).isEmpty():
        # Nothing to publish; only now is it worth a second look at the source to say why.
        if some_ids:
            counts = rows.agg(*missing_id_counts()).first()
            require_some_ids(counts["rows"], counts["without_id"])
        return ingest_summary(store.read_segment(path), "seen")
    facts = seen_vectors.get
    wrong = facts["wrong_size"]
    if wrong:
        raise ValueError(f"{wrong} vectors do not have {entry['vector_size']} elements")
    write_statistics(store.spark, facts, store.facts_path(entry, segment))
    covers = store.note_replaced(entry, segment, entry["segments"])
    store.add_segment(name, segment, embedder.model, facts["points"], tuple(covers))
    return ingest_summary(store.read_segment(path), "seen")
