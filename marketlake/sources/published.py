"""Tables whose state is one published list of folders.

    <table>/run=r<id>/[month_key=202401/]*.parquet   written once, never changed
    <table>/_lists/00000007.json                      which folders are the table

A writer puts what it changes into a run folder of its own and then publishes a list
that names, month by month, the folder that counts. The list of the greatest number is
the table. Publishing is a compare-and-set on that number: of two writers that started
from the same list one gets it, the other reads the new list and tries again. So a
reader sees the old rows or the new ones, never some of both, and a writer that dies
before publishing leaves folders that no list names.

A list may name further folders (`side`) that belong to the same state, such as what a
refresh needs to know of earlier rows. Readers keep working on the list they opened:
folders are deleted only once no kept list names them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketlake.sources import files

LISTS = "_lists"
RUN = "run"
#: key of the one folder of a table without months
WHOLE = ""
KEPT = 3


class Conflict(Exception):
    """Another writer has published first."""


@dataclass(frozen=True)
class Listing:
    number: int = 0
    schema: str = ""
    parts: dict[str, str] = field(default_factory=dict)
    side: dict[str, str] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {*self.parts.values(), *self.side.values()}

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.names_in(spark, f"{path}/{LISTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _file(path: str, number: int) -> str:
    return f"{path}/{LISTS}/{number:08d}.json"


def listing(spark: SparkSession, path: str, number: int | None = None) -> Listing | None:
    """The current list (or that of a number); None if nothing has been published."""
    if number is None:
        found = _numbers(spark, path)
        if not found:
            return None
        number = found[-1]
    made = json.loads(files.read_text(spark, _file(path, number)))
    return Listing(number, made["schema"], made["parts"], made["side"])


def publish(spark: SparkSession, path: str, new: Listing) -> None:
    """Make a list the state of the table, if its number is still free."""
    body = json.dumps({"schema": new.schema, "parts": new.parts, "side": new.side}, sort_keys=True)
    draft = f"{path}/{LISTS}/_draft-{uuid.uuid4().hex}"
    files.write_text(spark, draft, body)
    if not files.move_if_absent(spark, draft, _file(path, new.number)):
        raise Conflict(f"{path} already has a list {new.number}")


def commit(
    spark: SparkSession, path: str, change: Callable[[Listing | None], Listing | None], tries: int = 20
) -> Listing | None:
    """Publish what `change` makes of the current list, again from the newer list if
    another writer was first. `change` gives None if there is nothing to do."""
    for _ in range(tries):
        base = listing(spark, path)
        new = change(base)
        if new is None:
            return base
        try:
            publish(spark, path, replace(new, number=base.number + 1 if base else 1))
        except Conflict:
            continue
        drop_unlisted(spark, path)
        return listing(spark, path)
    raise Conflict(f"{path}: {tries} other writers were first")


def new_run() -> str:
    return f"{RUN}=r{uuid.uuid4().hex}"


def written_parts(spark: SparkSession, path: str, run: str, partition: str | None) -> dict[str, str]:
    """The folders of a run by month, as a list names them."""
    if partition is None:
        return {WHOLE: run}
    names = [n for n in files.names_in(spark, f"{path}/{run}") if n.startswith(f"{partition}=")]
    return {name.split("=", 1)[1]: f"{run}/{name}" for name in names}


def read(
    spark: SparkSession, path: str, found: Listing, months: Iterable | None = None
) -> DataFrame | None:
    """The rows of a list, or of some of its months only; None if it names no folder for
    them. Other months' folders are not even listed."""
    wanted = set(found.parts) if months is None else {str(m) for m in months}
    folders = [f"{path}/{found.parts[m]}" for m in sorted(wanted & set(found.parts))]
    if not folders:
        return None
    reader = spark.read.schema(found.columns).option("basePath", path)
    return reader.parquet(*folders).drop(RUN)


def read_side(spark: SparkSession, path: str, found: Listing | None, name: str) -> DataFrame | None:
    if found is None or name not in found.side:
        return None
    return spark.read.parquet(f"{path}/{found.side[name]}")


def drop_unlisted(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Delete all but the newest `keep` lists, and the folders that only the others
    name. Folders no list has named yet may belong to a writer at work and stay."""
    numbers = _numbers(spark, path)
    gone = [listing(spark, path, n) for n in numbers[:-keep]]
    if not gone:
        return
    kept = set().union(*(listing(spark, path, n).folders() for n in numbers[-keep:]))
    runs = {folder.split("/")[0] for folder in kept}
    for folder in set().union(*(old.folders() for old in gone)) - kept:
        run = folder.split("/")[0]
        files.delete_folder(spark, f"{path}/{folder if run in runs else run}")
    for old in gone:
        files.delete_folder(spark, _file(path, old.number))


def sweep(spark: SparkSession, path: str, before_ms: int) -> list[str]:
    """Delete what no list names and nothing has changed since `before_ms` (epoch
    milliseconds): folders of writers that died. Choose it longer ago than any job runs."""
    kept = {f.split("/")[0] for n in _numbers(spark, path) for f in listing(spark, path, n).folders()}
    fs, root = files.file_system(spark, path)
    gone = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if name not in kept and "=" in name and status.getModificationTime() < before_ms:
            files.delete_folder(spark, f"{path}/{name}")
            gone.append(name)
    return sorted(gone)
