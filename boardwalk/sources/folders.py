"""Folders of batch results, and merges that list what they cover.

A writer leaves one folder per batch, whole or not at all:

    base/writer=<name>/batch=<n>/part-*

A merge writes a folder of its own and then a file ``_covers`` in it, with a
number that grows by one per merge and the names of the folders or files that
it was made of. What is covered follows from those lists alone: no clock is
read, so no difference between the driver's and the store's time matters. A
merge that died before its ``_covers`` covers nothing.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from boardwalk.session import delete_path, list_dir, read_text, write_text

#: Writer name of merged folders; their batch is ``<level>-<hash of inputs>``.
COMPACTED = "compacted"
COVERS = "_covers"


@dataclass
class Folder:
    name: str  # writer=<name>/batch=<n>
    files: list[str]
    number: int = -1  # of a merge
    covers: set[str] = field(default_factory=set)

    @property
    def level(self) -> int:
        batch = self.name.split("/batch=")[1]
        return int(batch.split("-")[0]) if self.name.startswith(f"writer={COMPACTED}/") and "-" in batch else 0

    def paths(self) -> set[str]:
        return {f"{self.name}/{f}" for f in self.files}


def finished(spark: SparkSession, base: str) -> list[Folder]:
    """The whole folders under ``base``, by name."""
    out = []
    for writer in list_dir(spark, base):
        for batch in list_dir(spark, f"{base}/{writer}"):
            names = list_dir(spark, f"{base}/{writer}/{batch}")
            if "_SUCCESS" not in names:
                continue
            f = Folder(f"{writer}/{batch}", [n for n in names if not n.startswith(("_", "."))])
            if COVERS in names:
                said = json.loads(read_text(spark, f"{base}/{f.name}/{COVERS}"))
                f.number, f.covers = said["number"], set(said["covers"])
            out.append(f)
    return out


def covered(folders: list[Folder]) -> set[str]:
    """All that the merges say they cover."""
    return set().union(*(f.covers for f in folders))


def merged_name(level: int, inputs: list[Folder]) -> str:
    """The same inputs give the same folder, so a repeated merge replaces itself."""
    h = hashlib.sha256("\n".join(sorted(p for f in inputs for p in f.paths())).encode()).hexdigest()
    return f"writer={COMPACTED}/batch={level}-{h[:16]}"


def declare(spark: SparkSession, base: str, name: str, folders: list[Folder], covers: set[str]) -> None:
    """Says what the merge ``name``, whole by now, covers."""
    number = 1 + max((f.number for f in folders), default=-1)
    write_text(spark, f"{base}/{name}/{COVERS}", json.dumps({"number": number, "covers": sorted(covers)}))


def drop_covered_files(spark: SparkSession, base: str, folders: list[Folder], gone: set[str]) -> None:
    """Removes the files ``gone`` (``folder/file``), and folders left empty. A
    file that a replay has written since has another name, and stays."""
    for f in folders:
        dead = f.paths() & gone
        if not dead:
            continue
        if dead == f.paths():
            delete_path(spark, f"{base}/{f.name}")
        else:
            for path in dead:
                delete_path(spark, f"{base}/{path}")
