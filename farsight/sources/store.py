"""Collections kept as Parquet in a folder all executors share.

    <root>/registry/                                  one row per created collection
    <root>/changes/<name>/<version>.json              its later states, the latest counts
    <root>/collections/<name>/<segment>/shard=<hex>/  points, sorted by point id
    <root>/collections/<name>/<segment>-postings/     its words, see `postings`
    <root>/collections/<name>/<segment>-facts/        its counts and sketches, see `statistics`
    <root>/collections/<name>/<segment>-over-<mark>/  rows of older segments that it replaces, as bitmaps

An ingest writes one new segment and makes it visible by making the file of the next version; a failed or
refused one leaves nothing visible. That file can be made once only: of several writers one makes it, the others look
again and make the next, so none loses what another has written.

Where segments hold the same point the later one counts. An ingest notes which rows of older segments, by file and position, its
points replace; readers leave these out where they lie, so neither the base nor the ids of later segments are shuffled at a
search. `fold` merges neighbours of like size, so that after n small ingests a row has been written about log n
times; `sweep` deletes what no kept version shows.
"""

from __future__ import annotations

import itertools
import json
import math
import re
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distance import check_metric
from ..functions.sql import register_search_function
from ..operators.catalog import list_tables, matches_filter
from ..operators.creation import MODEL_DIMENSIONS, NAME_PATTERN, plan_creation
from ..operators.embedding import HashEmbedder
from ..session import shuffles_deleted
from . import commits
from .collection import Collection
from .postings import read_postings, write_postings
from .statistics import gathered, merged, write_statistics

REGISTRY_SCHEMA = (
    "version bigint, name string, vector_size int, distance string, model_name string, "
    "shard_digits int, segments array<string>, sizes array<bigint>, covers array<string>"
)
ENTRY_COLUMNS = ["name", "vector_size", "distance", "model_name", "shard_digits", "segments", "sizes", "covers"]
POINT_SCHEMA = (
    "point_id string, id string, text string, embedding array<float>, tokens array<string>, "
    "seen bigint, shard string"
)
POINT_COLUMNS = ["point_id", "id", "text", "embedding", "tokens", "seen", "shard"]
BITMAP_ROWS = 32_768  # positions in one of Spark's bitmaps
BITMAP_SCHEMA = "shard string, file string, bucket bigint, bitmap binary"
MAX_SHARD_DIGITS = 4
#: Older versions of a collection's state that are kept.
KEPT_VERSIONS = 20
#: So many neighbours of like size are merged; sizes are alike if they are within the same power of this number.
FAN = 4
#: What no kept version shows is deleted once it is this old, in seconds: readers may still be at it, or a writer about to show it.
GRACE_SECONDS = 24 * 3600
#: Bitmaps (of 32,768 rows each) are broadcast to a segment's readers up to this many; they take 4 KiB each.
MAX_BITMAPS = 4096
#: New ids are broadcast to find the rows that they replace, up to this many.
MAX_BROADCAST_IDS = 250_000


def view_name(collection: str) -> str:
    """The name of a collection in SQL: lower case, `_` for what no identifier may have."""
    return re.sub(r"\W", "_", collection.lower(), flags=re.ASCII)


class CollectionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._registry_path = f"{self.root}/registry"

    # ---- registry

    def _created(self) -> DataFrame:
        if not commits.exists(self.spark, self._registry_path):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self._registry_path)

    def _changes(self) -> DataFrame:
        if not commits.names(self.spark, f"{self.root}/changes"):
            return self._created()
        changed = self.spark.read.schema(REGISTRY_SCHEMA).json(f"{self.root}/changes/*/*.json")
        return self._created().unionByName(changed)

    def _versions(self, name: str) -> list[str]:
        """The files of a collection's states, the latest last."""
        folder = f"{self.root}/changes/{name.lower()}"
        return [f"{folder}/{file}" for file, _ in commits.names(self.spark, folder)]

    def registry(self) -> DataFrame:
        """The current entry of each collection, read anew at each call."""
        entry = ENTRY_COLUMNS
        return (
            self._changes()
            .groupBy(F.lower("name").alias("key"))
            .agg(F.max(F.struct("version", *entry)).alias("entry"))
            .select(*[f"entry.{column}" for column in ["version", *entry]])
        )

    def _find(self, name: str) -> Row | None:
        """The latest state of a collection; but for new ones this reads one small file."""
        while versions := self._versions(name):
            try:
                found = json.loads(commits.read(self.spark, versions[-1]))
            except Exception:
                if commits.exists(self.spark, versions[-1]):
                    raise
                continue  # gone since, as later versions have come
            return Row(**{column: found[column] for column in ["version", *ENTRY_COLUMNS]})
        mine = self._created().filter(F.lower("name") == name.lower())
        return mine.orderBy(F.desc("version")).limit(1).first()

    def entry(self, name: str) -> Row:
        found = self._find(name)
        if found is None:
            raise ValueError(f"no collection named {name!r}")
        return found

    def _one_change(self, *values) -> DataFrame:
        fields = T.StructType.fromDDL(REGISTRY_SCHEMA).fields
        return self.spark.range(1).select(
            *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values)]
        )

    def _record(self, changes: DataFrame) -> None:
        changes.repartition(1).write.mode("append").parquet(self._registry_path)

    # ---- creating and listing

    def create_many(self, requests: DataFrame, shard_digits: int = 1) -> DataFrame:
        """Create what a table of requests asks for; returns one status per request.

        `requests`: seq, name, vector_size, distance, model_name.
        """
        if not 0 < shard_digits <= MAX_SHARD_DIGITS:
            raise ValueError(f"shard_digits must be between 1 and {MAX_SHARD_DIGITS}")
        # The outcome is written down before the registry changes, or a second look would find
        # every new collection already there.
        outcome_path = f"{self.root}/creations/{uuid.uuid4().hex}"
        plan_creation(requests, self.registry()).write.parquet(outcome_path)
        outcome = self.spark.read.parquet(outcome_path)
        created = outcome.filter(F.col("status").startswith("created: "))
        self._record(
            created.select(
                F.lit(0).cast("bigint").alias("version"),
                "name",
                "vector_size",
                "distance",
                "model_name",
                F.lit(shard_digits).alias("shard_digits"),
                F.array().cast("array<string>").alias("segments"),
                F.array().cast("array<bigint>").alias("sizes"),
                F.array().cast("array<string>").alias("covers"),
            )
        )
        return outcome

    def create(
        self,
        name: str,
        vector_size: int | None = None,
        distance: str = "Cosine",
        model_name: str | None = None,
        shard_digits: int = 1,
    ) -> str:
        """Create one collection: 'created: name', or 'exists: name' and nothing is changed."""
        check_metric(distance)
        if not re.fullmatch(NAME_PATTERN, name):
            raise ValueError(f"{name!r} cannot name a collection")
        if vector_size is None and not model_name:
            raise ValueError(
                "no vector_size and no model_name: give an explicit vector_size or a known model"
            )
        if vector_size is None and model_name not in MODEL_DIMENSIONS:
            raise ValueError(
                f"unknown model {model_name!r}: give an explicit vector_size, or one of "
                f"{', '.join(MODEL_DIMENSIONS)}"
            )
        if not 0 < shard_digits <= MAX_SHARD_DIGITS:
            raise ValueError(f"shard_digits must be between 1 and {MAX_SHARD_DIGITS}")
        present = self._find(name)
        if present is not None:
            if present["name"] != name:
                raise ValueError(f"{name!r} differs from {present['name']!r} only by case")
            return f"exists: {name}"
        size = MODEL_DIMENSIONS[model_name] if vector_size is None else vector_size
        self._record(self._one_change(0, name, size, distance, model_name, shard_digits, [], [], []))
        return f"created: {name}"

    def list(self, collection_filter: str | None = None) -> DataFrame:
        return list_tables(self.registry(), collection_filter)

    def refresh(self, collection_filter: str | None = None, searchable: bool = False, embedder=None) -> list[str]:
        """Make the points of every matching collection a temporary view, whatever its name; see `view_name`.

        With `searchable` each also gets its relation of ID, TEXT, SCORE and QUERY, the function `search_<view>` (see
        `register_search`), if its vectors can be made: by the embedder, where the collection names its model or none, or
        hashed, where it names none or hashing. The registry is read once for all; the driver holds the entries found.
        """
        entries = self.registry().filter(matches_filter(F.col("name"), collection_filter)).collect()
        for entry in entries:
            self._points_of(entry).createOrReplaceTempView(view_name(entry["name"]))
            if searchable:
                model = entry["model_name"]
                if embedder is not None and model in (None, "", embedder.model):
                    self._register(entry, embedder)
                elif model in (None, "", HashEmbedder(entry["vector_size"]).model):
                    self._register(entry, None)
        return sorted(view_name(entry["name"]) for entry in entries)

    def _register(self, entry: Row, embedder, function: str | None = None, limit: int = 10) -> str:
        view = view_name(entry["name"])
        function = function or f"search_{view}"
        register_search_function(
            self.spark, function, view, entry["vector_size"], embedder, entry["distance"], default_limit=limit
        )
        return function

    def register_search(self, name: str, embedder=None, function: str | None = None, limit: int = 10) -> str:
        """A SQL function for a collection, with its metric: `search_<view>(query[, k[, offset]])`. Returns its name."""
        entry = self.entry(name)
        self._points_of(entry).createOrReplaceTempView(view_name(entry["name"]))
        return self._register(entry, embedder, function, limit)

    # ---- points

    def segment_path(self, name: str, segment: str) -> str:
        return f"{self.root}/collections/{name}/{segment}"

    def new_segment(self, entry: Row) -> tuple[str, str]:
        segment = uuid.uuid4().hex
        return segment, self.segment_path(entry["name"], segment)

    def write_points(self, points: DataFrame, path: str) -> None:
        with shuffles_deleted(self.spark):
            (
                points.select(*POINT_COLUMNS)
                .sortWithinPartitions("shard", "point_id")
                .write.partitionBy("shard")
                .option("compression", "zstd")
                .parquet(path)
            )

    def publish(self, name: str, change: Callable[[Row], dict]) -> Row:
        """Change the state of a collection, by what `change` makes of it, and return the new one.

        There is no look at what others do in between: the file of the next version can be made once, and who comes too
        late starts anew from the state that has become the latest.
        """
        while True:
            entry = self.entry(name)
            changed = {**entry.asDict(), **change(entry), "version": entry["version"] + 1}
            file = f"{self.root}/changes/{name.lower()}/{changed['version']:020d}.json"
            if commits.create_once(self.spark, file, json.dumps(changed)):
                for old in self._versions(name)[:-KEPT_VERSIONS]:
                    commits.delete(self.spark, old)
                return Row(**changed)

    def add_segment(self, name: str, segment: str, model_name: str | None = None, size: int = 0, covers: tuple = ()) -> Row:
        """Show one more segment, over all others; a model given binds the collection to it, or must be its own.

        `covers` says over which older segments the rows that it replaces have been noted (`note_replaced`).
        """

        def added(entry: Row) -> dict:
            if model_name and entry["model_name"] not in (None, model_name):
                raise ValueError(f"{name!r} holds vectors of {entry['model_name']!r}, not of {model_name!r}")
            return {
                "segments": [*entry["segments"], segment],
                "sizes": [*entry["sizes"], size],
                "covers": [*entry["covers"], *covers],
                "model_name": model_name or entry["model_name"],
            }

        return self.publish(name, added)

    def note_replaced(self, entry: Row, newer: str, older: list[str]) -> list[str]:
        """Find, in each of these older segments, the rows whose points a newer one holds too, and store them as bitmaps by file.

        Only ids are read, of the shards of the new points; the new ids are broadcast if they are few, which is counted.
        """
        if not older:
            return []
        ids = self._segment(entry, newer).select("point_id", "shard")
        few = ids.count() <= MAX_BROADCAST_IDS
        # The filter keeps every id; without one Spark does not prune shards by a join.
        ids = ids.filter("shard >= ''")
        ids = F.broadcast(ids) if few else ids
        hits = [
            self._placed(entry, segment)
            .select("point_id", "shard", "file", "row", F.lit(segment).alias("older"))
            .join(ids, ["point_id", "shard"], "left_semi")
            for segment in older
        ]
        bucket, position = F.floor(F.col("row") / BITMAP_ROWS), F.col("row") % BITMAP_ROWS
        maps = reduce(DataFrame.unionByName, hits).groupBy("older", "shard", "file", bucket.alias("bucket"))
        mark = uuid.uuid4().hex
        folder = self._over_path(entry, newer, mark)
        maps.agg(F.bitmap_construct_agg(position).alias("bitmap")).write.partitionBy("older").parquet(folder)
        counts = self.spark.read.schema(f"{BITMAP_SCHEMA}, older string").parquet(folder).groupBy("older").count()
        found = dict(tuple(row) for row in counts.collect())
        return [f"{newer}>{segment}>{found.get(segment, 0)}>{mark}" for segment in older]

    def _over_path(self, entry: Row, newer: str, mark: str) -> str:
        return f"{self.segment_path(entry['name'], newer)}-over-{mark}"

    def _placed(self, entry: Row, segment: str) -> DataFrame:
        """The points of a segment with the file, whose name is unique within its shard, and the row they stand in."""
        points = self.spark.read.schema(POINT_SCHEMA).parquet(self.segment_path(entry["name"], segment))
        return points.select(*POINT_COLUMNS, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))

    def _current(self, entry: Row) -> tuple[DataFrame, ...]:
        """The points of each segment that no later one has replaced.

        Rows noted as replaced are left out by position: their bitmaps, merged and broadcast up to MAX_BITMAPS, are looked up by file. Of
        later segments that have noted nothing about this one (they came in at the same time) the ids are joined.
        """
        noted = {(newer, older): (int(count), mark) for newer, older, count, mark in (c.split(">") for c in entry["covers"])}
        found = []
        for at, segment in enumerate(entry["segments"]):
            later = entry["segments"][at + 1 :]
            known = [(newer, *noted[newer, segment]) for newer in later if (newer, segment) in noted]
            known = [each for each in known if each[1]]
            points = self._segment(entry, segment)
            if known:
                folders = [f"{self._over_path(entry, newer, mark)}/older={segment}" for newer, _, mark in known]
                maps = [self.spark.read.schema(BITMAP_SCHEMA).parquet(folder) for folder in folders]
                maps = reduce(DataFrame.unionByName, maps).groupBy("shard", "file", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
                maps = F.broadcast(maps) if sum(count for _, count, _ in known) <= MAX_BITMAPS else maps
                placed = self._placed(entry, segment).withColumn("bucket", F.floor(F.col("row") / BITMAP_ROWS))
                byte = F.expr(f"conv(hex(substring(bitmap, (row % {BITMAP_ROWS}) div 8 + 1, 1)), 16, 10)").cast("bigint")
                gone = F.getbit(byte, (F.col("row") % 8).cast("int")) == 1
                points = placed.join(maps, ["shard", "file", "bucket"], "left").filter(F.col("bitmap").isNull() | ~gone)
                points = points.select(*POINT_COLUMNS)
            unknown = [newer for newer in later if (newer, segment) not in noted]
            if unknown:
                ids = [self._segment(entry, newer).select("point_id") for newer in unknown]
                points = points.join(reduce(DataFrame.unionByName, ids), "point_id", "left_anti")
            found.append(points)
        return tuple(found)

    def read_segment(self, path: str) -> DataFrame:
        return self.spark.read.schema(POINT_SCHEMA).parquet(path).select(*POINT_COLUMNS)

    def points(self, name: str) -> DataFrame:
        return self._points_of(self.entry(name))

    def _points_of(self, entry: Row) -> DataFrame:
        if not entry["segments"]:
            return self.spark.createDataFrame([], POINT_SCHEMA).select(*POINT_COLUMNS)
        return reduce(DataFrame.unionByName, self._current(entry))

    def _segment(self, entry: Row, segment: str) -> DataFrame:
        return self.read_segment(self.segment_path(entry["name"], segment))

    def compact(self, name: str, later_only: bool = False) -> None:
        """Fold all segments into one; or all but the first, which may be far larger."""
        entry = self.entry(name)
        self._merge(entry, int(later_only), len(entry["segments"]))

    def fold(self, name: str, fan: int = FAN) -> int:
        """Merge the last `fan` or more neighbours of like size, again and again, and return the number of merges.

        Sizes are numbers of points. A row moves to a segment of the next power of `fan` each time it is written, so its writes grow
        with the logarithm of the number of ingests. With no such neighbours this reads one small file.
        """
        for merges in itertools.count():
            entry = self.entry(name)
            tiers = [int(math.log(max(1, size), fan) + 1e-9) for size in entry["sizes"]]
            stop = len(tiers)
            start = next((at for at in range(stop) if stop - at >= fan and max(tiers[at:]) <= tiers[at] <= tiers[-1]), stop)
            if start == stop:
                start = next((at for at in range(stop - fan + 1) if len(set(tiers[at : at + fan])) == 1), stop)
                stop = min(stop, start + fan)
            if start == stop:
                return merges
            self._merge(entry, start, stop)

    def _merge(self, entry: Row, start: int, stop: int) -> None:
        """Write the segments from `start` up to `stop` as one; those above keep lying over it."""
        name, merged = entry["name"], entry["segments"][start:stop]
        if len(merged) < 2:
            return
        points = reduce(DataFrame.unionByName, self._current(entry)[start:stop])
        segment, path = self.new_segment(entry)
        spread = F.pmod(F.xxhash64("point_id"), F.lit(self.writers_per_shard(entry)))
        facts = Observation()
        self.write_points(points.repartition("shard", spread).observe(facts, *gathered(entry["vector_size"])), path)
        write_statistics(self.spark, facts.get, self.facts_path(entry, segment))
        size = facts.get["points"]
        covers = self.note_replaced(entry, segment, entry["segments"][:start])
        for newer in entry["segments"][stop:]:
            covers += self.note_replaced(entry, newer, [segment])

        def replaced(current: Row) -> dict:
            """What came in meanwhile stays above."""
            now = current["segments"]
            at = now.index(merged[0]) if merged[0] in now else 0
            if now[at : at + len(merged)] != merged:
                raise RuntimeError(f"{name!r} was folded by another writer meanwhile")
            kept = [each for each in current["covers"] if not set(each.split(">")[:2]) & set(merged)]
            return {
                "segments": [*now[:at], segment, *now[at + len(merged) :]],
                "sizes": [*current["sizes"][:at], size, *current["sizes"][at + len(merged) :]],
                "covers": [*kept, *covers],
            }

        self.publish(name, replaced)

    def sweep(self, name: str, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Delete what no kept version of the collection shows and is older than the grace time: refused and folded
        segments, with their words and bitmaps. Returns the names of the folders."""
        states = [json.loads(commits.read(self.spark, file)) for file in self._versions(name)[-KEPT_VERSIONS:]]
        latest = states[-1:] if not grace_seconds else states
        shown = {segment for state in latest for segment in state["segments"]}
        folder = f"{self.root}/collections/{self.entry(name)['name']}"
        gone = []
        for found, changed in commits.names(self.spark, folder):
            if found.partition("-")[0] in shown or time.time() - changed / 1000 < grace_seconds:
                continue
            commits.delete(self.spark, f"{folder}/{found}")
            gone.append(found)
        return gone

    def writers_per_shard(self, entry: Row) -> int:
        """Into how many parts a shard is hashed, so that all parts together fill the cluster
        evenly: eight for each shuffle partition."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(1, 8 * tasks // 16 ** entry["shard_digits"])

    # ---- facts

    def facts_path(self, entry: Row, segment: str) -> str:
        return f"{self.segment_path(entry['name'], segment)}-facts"

    def statistics(self, name: str) -> DataFrame:
        """One row of facts of a collection, see `statistics.merged`, with `noted`: whether every replaced point is among those
        counted. Only the small tables beside the segments are read; segments written without them are read once to make them."""
        entry = self.entry(name)
        for segment in entry["segments"]:
            if not commits.exists(self.spark, f"{self.facts_path(entry, segment)}/_SUCCESS"):
                row = self._segment(entry, segment).agg(*gathered(entry["vector_size"])).first()
                write_statistics(self.spark, row.asDict(), self.facts_path(entry, segment))
        noted = [c.split(">") for c in entry["covers"]]
        at = {segment: place for place, segment in enumerate(entry["segments"])}
        maps = []
        for older in entry["segments"]:
            folders = [self._over_path(entry, n, mark) for n, o, count, mark in noted if o == older and n in at and int(count)]
            if folders:
                found = [self.spark.read.schema(BITMAP_SCHEMA).parquet(f"{folder}/older={older}") for folder in folders]
                found = reduce(DataFrame.unionByName, found).groupBy("shard", "file", "bucket")
                maps.append(found.agg(F.bitmap_or_agg("bitmap").alias("bitmap")).select("bitmap"))
        pairs = {(n, o) for n, o, *_ in noted}
        whole = all((n, o) in pairs for o in at for n in at if at[n] > at[o])
        facts = merged(self.spark, [self.facts_path(entry, segment) for segment in entry["segments"]], maps)
        return facts.withColumn("noted", F.lit(whole))

    # ---- words

    def _postings_path(self, entry: Row, segment: str) -> str:
        return f"{self.segment_path(entry['name'], segment)}-postings"

    def _has_postings(self, entry: Row, segment: str) -> bool:
        return commits.exists(self.spark, f"{self._postings_path(entry, segment)}/_SUCCESS")

    def build_postings(self, name: str) -> int:
        """Index the words of the segments that have no postings yet, and return their number.

        The searches then find the points of a keyword there (`postings.points_with`). They do so once all segments have
        postings; after an ingest or a folding this is to be called again, and costs what the new segments cost.
        """
        entry = self.entry(name)
        missing = [segment for segment in entry["segments"] if not self._has_postings(entry, segment)]
        for segment in missing:
            write_postings(self._segment(entry, segment), self._postings_path(entry, segment))
        return len(missing)

    def collection(self, name: str) -> Collection:
        entry = self.entry(name)
        indexed = bool(entry["segments"]) and all(self._has_postings(entry, segment) for segment in entry["segments"])
        lists = [read_postings(self.spark, self._postings_path(entry, s)) for s in entry["segments"]] if indexed else []
        return Collection(
            entry["name"],
            self._points_of(entry),
            entry["vector_size"],
            entry["distance"],
            entry["model_name"],
            entry["shard_digits"],
            tuple(self._segment(entry, segment) for segment in entry["segments"]),
            self._current(entry) if indexed else (),
            tuple(lists),
        )
