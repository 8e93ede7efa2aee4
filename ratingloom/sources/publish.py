"""Replacing folders as one step: staged writes, a manifest, a journal, renames.

A run writes every folder beside its target under a hidden name. Only when all are whole
does it publish: a manifest goes into each folder, a journal lists the moves, and then each
target is swapped by two renames. A run that fails before the journal leaves the old folders
untouched; one that is ended after it is completed by ``recover``, which a run calls first.
Between its two renames a target is missing for a moment, but never half there, and old
and new folders of one run are told apart by the run's id in the manifests.

Renames are single steps on HDFS and local disks; an object store needs a file system with
such renames. One run at a time may publish to a target.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

MANIFEST = "_manifest.json"


class Files:
    """The few file operations that publishing needs, on whatever file system a path has."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self.jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.conf), found

    def exists(self, path: str) -> bool:
        system, found = self._at(path)
        return system.exists(found)

    def rename(self, source: str, target: str) -> None:
        system, found = self._at(source)
        if not system.rename(found, self.jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"{source} cannot be renamed to {target}")

    def delete(self, path: str) -> None:
        system, found = self._at(path)
        system.delete(found, True)

    def read(self, path: str) -> str:
        system, found = self._at(path)
        stream = system.open(found)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def data_files(self, path: str) -> list[str]:
        """The path itself if it is a file, else the data files below it."""
        system, found = self._at(path)
        if system.getFileStatus(found).isFile():
            return [path]
        return [f"{path.rstrip('/')}/{name}" for name in self.listing(path)]

    def first_line(self, path: str) -> str:
        system, found = self._at(path)
        reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(system.open(found), "UTF-8"))
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    def write(self, path: str, text: str) -> None:
        """The whole text or nothing: written under another name, then renamed."""
        system, found = self._at(path)
        part = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
        stream = system.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        system.delete(found, True)
        self.rename(part.toString(), path)

    def names(self, folder: str) -> list[str]:
        system, found = self._at(folder)
        return [s.getPath().getName() for s in system.listStatus(found)] if system.exists(found) else []

    def listing(self, folder: str) -> dict[str, int]:
        """Sizes of the data files below a folder, by relative path; names that readers skip are left out."""
        system, found = self._at(folder)
        base, sizes = system.makeQualified(found).toUri().getPath().rstrip("/") + "/", {}
        each = system.listFiles(found, True)
        while each.hasNext():
            status = each.next()
            name = status.getPath().toUri().getPath().removeprefix(base)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                sizes[name] = status.getLen()
        return dict(sorted(sizes.items()))


def _beside(target: str, suffix: str) -> str:
    """A name next to the target that readers of the parent folder skip."""
    folder, base = posixpath.split(target.rstrip("/"))
    return posixpath.join(folder, f"_{base}.{suffix}")


class Publication:
    """The folders that one run replaces together. The first one's place holds the journal."""

    def __init__(self, spark: SparkSession, targets: list[str]) -> None:
        self.files, self.targets = Files(spark), [t.rstrip("/") for t in targets]
        self.run = uuid.uuid4().hex
        self.staged = {t: _beside(t, f"{self.run}.staged") for t in self.targets}

    def __enter__(self) -> "Publication":
        recover(self.files, self.targets)
        return self

    def __exit__(self, failed, *_: object) -> None:
        journal = _beside(self.targets[0], "journal")
        if failed is not None and not self.files.exists(journal):
            for path in self.staged.values():
                self.files.delete(path)

    def publish(self, rows: Mapping[str, Mapping[str, int]]) -> None:
        """Swap every target. ``rows``: of each target the rows of its tables, by relative path."""
        for target, path in self.staged.items():
            self.files.write(f"{path}/{MANIFEST}", manifest_text(self.run, rows.get(target, {}), self.files.listing(path)))
        swap(self.files, self.targets[0], {target: path for target, path in self.staged.items()}, {})


def manifest_text(run: str, rows: Mapping[str, int], files: Mapping[str, int]) -> str:
    tables = {name: {"rows": n} for name, n in sorted(rows.items())}
    return json.dumps({"run": run, "tables": tables, "files": dict(sorted(files.items()))}, indent=1)


def swap(files: Files, first: str, moves: Mapping[str, str | None], texts: Mapping[str, str]) -> None:
    """Replace each target folder by its staged one (None: remove it), then write small files.

    All or nothing, by a journal beside the folder ``first``: an ended swap is completed by
    ``recover`` with that folder.
    """
    journal = _beside(first, "journal")
    listed = [[staged, target] for target, staged in moves.items()]
    files.write(journal, json.dumps({"moves": listed, "texts": list(texts.items())}))
    _carry_out(files, journal)


def _carry_out(files: Files, journal: str) -> None:
    """Every step of a journal, from wherever an earlier attempt was ended."""
    steps = json.loads(files.read(journal))
    for staged, target in steps["moves"]:
        old = _beside(target, "old")
        if staged is None or files.exists(staged):
            if files.exists(target):
                files.delete(old)
                files.rename(target, old)
            if staged is not None:
                files.rename(staged, target)
        files.delete(old)
    for path, text in steps["texts"]:
        files.write(path, text)
    files.delete(journal)


def recover(files: Files, targets: list[str]) -> None:
    """Complete a publication that was ended after its journal; remove what earlier failed runs staged."""
    journal = _beside(targets[0], "journal")
    if files.exists(journal):
        _carry_out(files, journal)
    for target in targets:
        folder, base = posixpath.split(target)
        for name in files.names(folder or "."):
            if name.startswith(f"_{base}.") and name.endswith(".staged"):
                files.delete(posixpath.join(folder, name))


def read_manifest(spark: SparkSession, folder: str) -> dict:
    return json.loads(Files(spark).read(f"{folder.rstrip('/')}/{MANIFEST}"))


def damaged_files(spark: SparkSession, folder: str) -> list[str]:
    """Files of a published folder that are missing, of another size, or not of its run."""
    wanted, found = read_manifest(spark, folder)["files"], Files(spark).listing(folder.rstrip("/"))
    return sorted(name for name in {*wanted, *found} if wanted.get(name) != found.get(name))
