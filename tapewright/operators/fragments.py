"""A JSON document of any size: sorted fragments with a manifest, put together file by file.

A list of the document is sorted by range and written as text, an item per line, by as many tasks as
it takes; no task holds more than its range. The manifest tells the fragments in order. The document
is then the fragments' bytes one after the other, copied through a small buffer.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.times import iso_text
from tapewright.sources.storage import concatenate, list_names

_PART = re.compile(r"part-(\d+)")
MANIFEST = "list string, place int, file string, bytes long"
_OPTIONS = {"ignoreNullFields": "false"}


@dataclass(frozen=True)
class Part:
    """A list of a document: its rows, their order, and the column that is written as ISO text."""

    rows: DataFrame
    keys: list[Column]
    time: str | None = None

    def item(self) -> Column:
        return F.struct(*[iso_text(self.rows, c).alias(c) if c == self.time else F.col(c) for c in self.rows.columns])

    def item_type(self) -> T.StructType:
        return self.rows.select(self.item().alias("item")).schema["item"].dataType


def write_fragments(part: Part, name: str, directory: str) -> DataFrame:
    """Write a list below ``directory`` in fragments; returns its manifest."""
    spark = part.rows.sparkSession
    ordered = part.rows.orderBy(*part.keys)
    # A comma leads each item, as no task knows which item is the last one.
    lines = Part(ordered, part.keys, part.time).item()
    text = ordered.select(F.concat(F.lit(","), F.to_json(lines, _OPTIONS)).alias("value"))
    text.write.mode("errorifexists").text(f"{directory}/{name}")
    files = [(int(_PART.match(n)[1]), n, size) for n, size in list_names(spark, f"{directory}/{name}") if size and _PART.match(n)]
    rows = [(name, place, f"{name}/{file}", size) for place, (_, file, size) in enumerate(sorted(files))]
    return spark.createDataFrame(rows, MANIFEST)


def write_document(spark: SparkSession, summary: dict, parts: dict[str, Part], directory: str, target: str) -> DataFrame:
    """Write the document ``target``, by way of fragments below ``directory``; returns the manifest."""
    manifests = [write_fragments(part, name, directory) for name, part in parts.items()]
    pieces: list[str | tuple[str, int]] = ['{"summary":' + json.dumps(summary)]
    out = None
    for name, manifest in zip(parts, manifests):
        pieces.append(f',\n"{name}":[\n')
        for row in sorted(manifest.collect()):  # a row per file
            pieces.append((f"{directory}/{row['file']}", 0 if row["place"] else 1))
        pieces.append("]")
        out = manifest if out is None else out.unionByName(manifest)
    concatenate(spark, target, [*pieces, "}\n"])
    return out


def read_fragments(spark: SparkSession, directory: str, name: str, item: T.StructType) -> DataFrame:
    """The items of a list from its fragments."""
    lines = spark.read.text(f"{directory}/{name}")
    return lines.select(F.from_json(F.substring("value", 2, 1 << 30), item).alias("item")).select("item.*")
