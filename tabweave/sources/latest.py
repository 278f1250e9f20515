"""The latest runs of a history, kept up to date from what was appended since.

A state names the table of latest runs and the files and tables of the history that went into it. Bringing it up
to date reads only others. Latest runs of latest runs are the same, so a table that holds some records again does no harm.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tabweave.operators.runs import latest_runs
from tabweave.sources.compaction import appended_files, read_manifest
from tabweave.sources.history import load_records
from tabweave.sources.schemas import STORED_RUN_SCHEMA
from tabweave.storage import get_text, names_in, put_text, remove

_FOLDER = "_latest"
_NAME = "state-{:08d}.json"


@dataclass(frozen=True)
class _State:
    number: int = 0
    table: str | None = None
    before: str | None = None
    files: list[str] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)


def _read_state(spark: SparkSession, folder: str) -> _State:
    names = [n for n in names_in(spark, folder) if n.startswith("state-") and n.endswith(".json")]
    return _State(**json.loads(get_text(spark, f"{folder}/{names[-1]}"))) if names else _State()


def maintained_latest(spark: SparkSession, path: str) -> DataFrame:
    """The last record of each model in each task, as :func:`tabweave.operators.runs.latest_runs` of the whole history.

    Records that were appended since the last call are read, together with the table that it left; the history may be
    folded at any time. If two calls run at once, one of them sets the state and both have the right result.
    """
    path = path.rstrip("/")
    folder = f"{path}/{_FOLDER}"
    state, manifest = _read_state(spark, folder), read_manifest(spark, path)
    files = appended_files(spark, path, manifest)
    # A table made only of what is known already holds nothing new.
    known = set(state.tables)
    if manifest.tables and {*manifest.folded} <= {*state.files} and {*manifest.retired} <= known:
        known.add(manifest.tables[-1])
    new_files = [f for f in files if f not in set(state.files)]
    new_tables = [t for t in manifest.tables if t not in known]
    old = [] if state.table is None else [spark.read.schema(STORED_RUN_SCHEMA).parquet(f"{folder}/{state.table}")]
    if not new_files and not new_tables and old:
        return old[0]
    records = load_records(spark, path, new_files, new_tables)
    for table in old:
        records = records.unionByName(table)
    name = uuid.uuid4().hex
    latest_runs(records).write.parquet(f"{folder}/{name}")
    after = _State(state.number + 1, name, state.table, files, manifest.tables)
    try:
        put_text(spark, f"{folder}/{_NAME.format(after.number)}", json.dumps(asdict(after)))
    except FileExistsError:
        pass  # another call was faster; this table is as good for its caller
    else:
        if state.before is not None:
            remove(spark, f"{folder}/{state.before}")
    return spark.read.schema(STORED_RUN_SCHEMA).parquet(f"{folder}/{name}")
