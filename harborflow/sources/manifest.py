"""Which loads of a table its readers see.

A compacted load takes the place of others from the moment the table's manifest is replaced, by one rename. The manifest names the
compacted loads that count and the folders they replace, so readers see the old folders or the new one, never both.
"""

from __future__ import annotations

import json
import os
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from harborflow.sources.files import read_text, replace_text

# Last partition level of every table that micro-batches append to.
LOAD = "load"
COMPACTED = "compacted-"


class Manifest(NamedTuple):
    """Compacted loads that count, and replaced folders (partition values and load, joined by slashes) not yet removed."""

    published: tuple[str, ...] = ()
    replaced: tuple[str, ...] = ()


def manifest_path(base: str, name: str) -> str:
    return os.path.join(base, "_manifests", name)


def read_manifest(spark: SparkSession, base: str, name: str) -> Manifest:
    text = read_text(spark, manifest_path(base, name))
    if text is None:
        return Manifest()
    return Manifest(**{field: tuple(values) for field, values in json.loads(text).items()})


def write_manifest(spark: SparkSession, base: str, name: str, manifest: Manifest) -> None:
    replace_text(spark, manifest_path(base, name), json.dumps(manifest._asdict()))


def folder_key(partition_by: tuple[str, ...]) -> Column:
    """A row's folder as the manifest writes it; a null partition value is an empty text."""
    levels = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*partition_by, LOAD)]
    return F.concat_ws("/", *levels)


def counts(manifest: Manifest, partition_by: tuple[str, ...]) -> Column:
    """Whether a row's folder counts; over partition columns alone, so it prunes folders before they are read."""
    load = F.col(LOAD).cast("string")
    seen = ~load.startswith(COMPACTED) | load.isin(*manifest.published) if manifest.published else ~load.startswith(COMPACTED)
    return seen & ~folder_key(partition_by).isin(*manifest.replaced) if manifest.replaced else seen
