"""Listing collections as tables, and choosing among them by name."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns every collection shows.
RESULT_COLUMNS = {"ID": "string", "TEXT": "string", "SCORE": "double", "QUERY": "string"}
RESULT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RESULT_COLUMNS.items())


def glob_pattern(glob: str) -> str:
    """A regular expression for a glob: `*` any run, `?` one character, all else itself."""
    wild = {"*": ".*", "?": "."}
    body = "".join(wild.get(char) or re.escape(char) for char in glob)
    return rf"(?s)\A{body}\z"


def matches_filter(name: Column, collection_filter: str | None) -> Column:
    """True where a name fits any entry of a comma-separated list of globs; blank fits all."""
    if not collection_filter:
        return F.lit(True)
    entries = [entry.strip() for entry in collection_filter.split(",")]
    fits = F.lit(False)
    for entry in filter(None, entries):
        fits = fits | name.rlike(glob_pattern(entry))
    return fits


def list_tables(registered: DataFrame, collection_filter: str | None = None) -> DataFrame:
    """One row per collection and column; the table name is upper-cased."""
    columns = F.array(
        *[
            F.struct(
                F.lit(place).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
            )
            for place, (name, kind) in enumerate(RESULT_COLUMNS.items(), start=1)
        ]
    )
    return (
        registered.filter(matches_filter(F.col("name"), collection_filter))
        .select(F.upper("name").alias("table_name"), F.explode(columns).alias("column"))
        .select("table_name", "column.position", "column.column_name", "column.data_type")
    )
