"""Folding the many small files of an append-only history into few sorted ones, while appends go on.

A history is a folder of appended files. A manifest in it names sorted tables and the appended files they hold, so
that each record is read once, from either. Manifests are numbered and put in place as a whole; of two that
fold at a time one wins and the other leaves nothing. What a manifest has folded is deleted when the next one is in
place, so readers that began with the manifest before find all they need.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabweave.storage import get_text, names_in, put_text, remove

_MANIFESTS, _TABLES = "_manifests", "_tables"
_NAME = "manifest-{:08d}.json"
MERGED_AT = 8  # sorted tables that are made into one


@dataclass(frozen=True)
class Manifest:
    """``tables`` hold the records of the appended files ``folded`` and of all folded before; ``retired`` are older tables."""

    number: int = 0
    tables: list[str] = field(default_factory=list)
    folded: list[str] = field(default_factory=list)
    retired: list[str] = field(default_factory=list)


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest of a history; an empty one if it was never folded."""
    names = [n for n in names_in(spark, f"{path}/{_MANIFESTS}") if n.startswith("manifest-") and n.endswith(".json")]
    return Manifest(**json.loads(get_text(spark, f"{path}/{_MANIFESTS}/{names[-1]}"))) if names else Manifest()


def appended_files(spark: SparkSession, path: str, manifest: Manifest) -> list[str]:
    """Names of the appended files that no table holds."""
    held = set(manifest.folded)
    return [n for n in names_in(spark, path) if not n.startswith(("_", ".")) and n not in held]


def table_paths(path: str, manifest: Manifest) -> list[str]:
    return [f"{path}/{_TABLES}/{t}" for t in manifest.tables]


def fold(spark: SparkSession, path: str, load, order: list[str]) -> bool:
    """Fold the files appended so far; whether there were any and this call was the one that did it.

    ``load(files, tables)`` gives the records of some appended files and tables. Records that it leaves out, such as broken
    ones, are gone afterwards. Their order in the tables is that of ``order``.
    """
    before = read_manifest(spark, path)
    files = appended_files(spark, path, before)
    if not files:
        return False
    merged = before.tables if len(before.tables) + 1 >= MERGED_AT else []
    records: DataFrame = load([f"{path}/{n}" for n in files], [f"{path}/{_TABLES}/{t}" for t in merged])
    name = uuid.uuid4().hex
    records.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/{_TABLES}/{name}")
    kept = [t for t in before.tables if t not in merged]
    after = Manifest(before.number + 1, [*kept, name], files, merged)
    try:
        put_text(spark, f"{path}/{_MANIFESTS}/{_NAME.format(after.number)}", json.dumps(asdict(after)))
    except FileExistsError:
        remove(spark, f"{path}/{_TABLES}/{name}")
        return False
    for old in [*[f"{path}/{n}" for n in before.folded], *[f"{path}/{_TABLES}/{t}" for t in before.retired]]:
        remove(spark, old)
    return True
