"""Table sets that change all at once, and appends that can be repeated.

A set is written to a folder of its own and becomes current by one small file, its manifest: readers resolve the newest
manifest first and then read only that version's folders, so they see one version of all tables, whatever is being
written meanwhile. Nothing is renamed, which on object stores is not a single step. A batch is written beside its table
and put in place under its own name, so repeating it replaces it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from orrery.sources.sinks import FACT_LAYOUTS, Layout, file_system, open_tables, publish, write_table

MANIFESTS = "_manifests"


class NoVersion(RuntimeError):
    """Nothing was ever published below this folder."""


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = file_system(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())


def _commit(spark: SparkSession, root: str, content: str) -> int:
    """Write the next manifest; of writers that ask for one number, one gets it and the others take the next.

    The rename moves one small file onto a name that does not exist, and fails where another writer was first.
    """
    number = (_numbers(spark, root) or [0])[-1] + 1
    while True:
        fs, target = file_system(spark, f"{root}/{MANIFESTS}/{number:020d}")
        if not fs.exists(target):
            # Written under a hidden name first, so that a manifest is never seen half written.
            draft = file_system(spark, f"{root}/{MANIFESTS}/.draft-{uuid.uuid4().hex}")[1]
            out = fs.create(draft, False)
            try:
                out.write(bytearray(content.encode()))
            finally:
                out.close()
            if fs.rename(draft, target):
                return number
            fs.delete(draft, False)
        number += 1


def publish_set(
    tables: Mapping[str, DataFrame],
    root: str,
    rename: Mapping[str, str] = {},
    layouts: Mapping[str, Layout] = FACT_LAYOUTS,
    required: Mapping[str, Sequence[str]] = {},
    derive: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]] | None = None,
) -> DataFrame:
    """Write a whole set of tables as one new version and make it current; one report row per table.

    ``derive`` gets the tables as they are stored in this version and names the tables of it that are computed from
    them, so that the tables are built once, however many results need them. If a table cannot be written, is not stored whole, or has a null in a ``required`` column, nothing changes for
    readers. Older versions stay until ``drop_versions``.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"v-{uuid.uuid4().hex[:16]}"
    folder = f"{root}/{version}"
    report = publish(tables, folder, rename, layouts, required=required)
    names = [rename.get(name, name) for name in tables]
    if derive is not None:
        schemas = {rename.get(name, name): df.schema for name, df in tables.items()}
        stored = open_tables(spark, folder, names, schemas)
        results = derive({name: stored[rename.get(name, name)] for name in tables})
        if set(results) & set(tables):
            raise ValueError(f"derived tables repeat given ones: {', '.join(sorted(set(results) & set(tables)))}")
        report = report.unionAll(publish(results, folder, rename, layouts, required=required))
        names += [rename.get(name, name) for name in results]
    _commit(spark, root, json.dumps({"version": version, "tables": names}))
    return report


def current_version(spark: SparkSession, root: str) -> tuple[str, list[str]]:
    """Folder and table names of the newest version."""
    numbers = _numbers(spark, root)
    if not numbers:
        raise NoVersion(root)
    text = spark.read.text(f"{root}/{MANIFESTS}/{numbers[-1]:020d}", wholetext=True).first()["value"]
    manifest = json.loads(text)
    return f"{root}/{manifest['version']}", manifest["tables"]


def open_set(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the newest version, resolved once: later loads don't change what these read."""
    folder, names = current_version(spark, root)
    return open_tables(spark, folder, names)


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` versions and their manifests; returns how many went."""
    if keep < 1:
        raise ValueError("keep at least the current version")
    gone = _numbers(spark, root)[:-keep]
    for number in gone:
        path = f"{root}/{MANIFESTS}/{number:020d}"
        version = json.loads(spark.read.text(path, wholetext=True).first()["value"])["version"]
        fs, manifest = file_system(spark, path)
        fs.delete(manifest, False)  # first the way to it, then the version
        fs.delete(file_system(spark, f"{root}/{version}")[1], True)
    return len(gone)


def append_batch(
    df: DataFrame, path: str, batch: str, layout: Layout | None = None, required: Sequence[str] = ()
) -> int:
    """Add the rows of a named batch to a table stored by batches; returns the rows written.

    The same batch again replaces its earlier rows, so a load that died can simply be repeated. The batch is written
    and verified in a hidden folder before it is put in place: one that fails leaves the table as it was.
    """
    if not batch or any(not (c.isalnum() or c in "-_.") for c in batch):
        raise ValueError(f"a batch is named with letters, digits, '-', '_' and '.': {batch!r}")
    spark = df.sparkSession
    draft = f"{path}/_draft-{uuid.uuid4().hex[:12]}"
    fs, staged = file_system(spark, draft)
    try:
        written = write_table(df, draft, layout, required=required)
        place = file_system(spark, f"{path}/load_batch={batch}")[1]
        if fs.exists(place):
            fs.delete(place, True)
        if not fs.rename(staged, place):
            raise OSError(f"cannot put batch {batch} of {path} in place")
    finally:
        if fs.exists(staged):
            fs.delete(staged, True)
    return written


def open_batches(spark: SparkSession, path: str, batches: Sequence[str] = ()) -> DataFrame:
    """The table's rows without its layout columns, of all batches or the named ones (only their folders are read)."""
    rows = spark.read.parquet(path)
    if batches:
        rows = rows.where(rows["load_batch"].cast("string").isin(*batches))
    return rows.drop("load_batch", *(layout.partition for layout in FACT_LAYOUTS.values()))
