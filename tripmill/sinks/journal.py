"""Changes of a table's files that are finished by whoever comes next, if their writer dies.

New rows are first written whole to a folder of the table that readers skip. Then one small file, the journal,
says which files to move in and which to remove; creating it decides that the change happens. Every
step can be done again, so a run that finds a journal finishes it before it does anything else.
Only files are moved, never folders, which object stores can't rename as a whole. One writer at a time: a second
one fails when it creates its journal. Readers may see files of both states while a change is carried out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tripmill.storage import child_names, create_new, exists, make_folder, read_text, remove, rename

_JOURNAL = "_journal.json"


def staging(path: str) -> str:
    """A new folder of the table for rows that are not in it yet."""
    return f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex[:12]}"


def files_below(spark: SparkSession, folder: str, inside: Iterable[str] = ("",)) -> list[str]:
    """Names of files in ``folder`` and the subfolders ``inside``, relative to it."""
    found = []
    for part in inside:
        at = f"{folder.rstrip('/')}/{part}".rstrip("/")
        prefix = f"{part}/" if part else ""
        found += [f"{prefix}{n}" for n in child_names(spark, at) if "." in n]
    return found


def commit(spark: SparkSession, path: str, staged: str, add: Sequence[str], drop: Sequence[str]) -> None:
    """Move the files ``add`` from ``staged`` into the table and remove the files ``drop`` from it."""
    said = {"staged": staged.rsplit("/", 1)[1], "add": list(add), "drop": list(drop)}
    create_new(spark, f"{path.rstrip('/')}/{_JOURNAL}", json.dumps(said))
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a change that was decided on, if there is one. A journal that was never finished decides nothing."""
    root = path.rstrip("/")
    journal = f"{root}/{_JOURNAL}"
    if not exists(spark, journal):
        return False
    try:
        said = json.loads(read_text(spark, journal))
    except ValueError:
        remove(spark, journal)
        return False
    staged = f"{root}/{said['staged']}"
    for folder in {name.rpartition("/")[0] for name in said["add"]} - {""}:
        make_folder(spark, f"{root}/{folder}")

    def move(name: str) -> None:
        if exists(spark, f"{staged}/{name}") and not rename(spark, f"{staged}/{name}", f"{root}/{name}"):
            raise OSError(f"{staged}/{name} can't be moved")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, said["add"]))
        list(pool.map(lambda name: remove(spark, f"{root}/{name}"), said["drop"]))
    for folder in {name.rpartition("/")[0] for name in said["drop"]} - {""}:
        if not child_names(spark, f"{root}/{folder}"):
            remove(spark, f"{root}/{folder}")
    remove(spark, staged)
    remove(spark, journal)
    return True
