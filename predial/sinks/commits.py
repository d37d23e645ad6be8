"""Replacing several tables or periods as one step, and runs that notice each other.

A run writes its tables into a folder of its own under `<root>/_commits`, where they are read
back and checked. Then one rename puts its manifest in place as the next version: from there
on the run counts, whatever happens to it. Last, the folders that the manifest names are moved
to where the tables are, and the version is marked as done.

- A run that dies before the rename has changed nothing; its folder goes when its lease expires.
- A run that dies after it is rolled forward by the next one, or by `recover`. Until then the
  readers here (`current_folders`) take the new folders from where they still are, so they see
  all of a version or nothing of it. Somebody who reads the table folders without them may
  meet old next to new ones while folders are being moved.
- A run replaces what it saw at its start: if another one has published the same table or
  period since then, it is refused, and nothing of it is published. Runs that replace
  different ones both pass.

The file system must rename in one step, as HDFS, local disks and mounted shares do.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import SparkSession

from predial.contracts import PERIOD, ContractError
from predial.sinks.folders import Folders
from predial.sinks.leases import Lease

LOG = "_commits"
KEPT = 200  # manifests; of an earlier version nobody can tell any more what it replaced


def _numbers(folders: Folders, root: str, suffix: str) -> list[int]:
    found = (re.fullmatch(rf"(\d{{8}})\.{suffix}", n) for n in folders.names(f"{root}/{LOG}"))
    return [int(m.group(1)) for m in found if m]


def _manifest(root: str, version: int, suffix: str = "json") -> str:
    return f"{root}/{LOG}/{version:08d}.{suffix}"


def current_version(folders: Folders, root: str) -> int:
    return max(_numbers(folders, root, "json"), default=0)


def _open_versions(folders: Folders, root: str) -> list[tuple[int, dict[str, Any]]]:
    """Versions that count and whose folders may not all be in their places, oldest first."""
    open_ones = sorted({*_numbers(folders, root, "json")} - {*_numbers(folders, root, "done")})
    return [(n, folders.read(_manifest(root, n))) for n in open_ones]


def _place(folders: Folders, root: str, staged: str, target: str, old: str) -> None:
    """Put one folder in its place; does nothing more when done before."""
    source, place, aside = f"{root}/{staged}", f"{root}/{target}", f"{root}/{old}"
    if not folders.exists(source):
        return
    folders.create(place.rpartition("/")[0])
    folders.create(aside.rpartition("/")[0])
    folders.move(place, aside)
    if not folders.move(source, place) and not folders.exists(place):
        # Another run moved it while this one looked, and what went aside was the new folder.
        folders.move(aside, place)


def recover(spark: SparkSession, root: str, folders: Folders | None = None) -> list[int]:
    """Roll forward what killed runs had published; the versions that were open."""
    folders = folders or Folders(spark, root)
    found = _open_versions(folders, root)
    for version, manifest in found:
        for staged, target in manifest["folders"]:
            _place(folders, root, staged, target, f"{LOG}/old-{version:08d}/{target}")
        folders.remove(f"{root}/{LOG}/old-{version:08d}")
        folders.remove(f"{root}/{LOG}/{manifest['run']}")
        folders.write(_manifest(root, version, "done"), {})
    return [version for version, _ in found]


def begin(spark: SparkSession, root: str) -> int:
    """Bring a root in order, and the version that a run beginning now is to replace."""
    folders = Folders(spark, root)
    recover(spark, root, folders)
    return current_version(folders, root)


def current_folders(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """Where the folders of a table that are not in their places yet are, by target."""
    folders, found = Folders(spark, root), {}
    for _, manifest in _open_versions(folders, root):
        for staged, target in manifest["folders"]:
            if target.split("/")[0] == table and folders.exists(f"{root}/{staged}"):
                found[target] = f"{root}/{staged}"
    return found


class Publication:
    """One run's replacement of tables and periods under a root."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        since: int | None = None,
        folders: Folders | None = None,
    ):
        self.spark, self.root = spark, root
        self.folders = folders or Folders(spark, root)
        self._new_root = not self.folders.exists(root)
        recover(spark, root, self.folders)
        self.since = current_version(self.folders, root) if since is None else since
        self.run = f"run-{uuid.uuid4().hex}"
        self.folder = f"{root}/{LOG}/{self.run}"
        self.folders.create(self.folder)
        self.lease = Lease(spark, self.folder)
        self.lease.sweep(f"{root}/{LOG}")
        self._entries: list[tuple[str, str]] = []

    def staged(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def replaces(self, table: str, periods: Sequence[str] = ()) -> None:
        """The staged table will replace the present one, or these periods of it."""
        parts = [f"{table}/{PERIOD}={p}" for p in periods] or [table]
        self._entries += [(f"{LOG}/{self.run}/{part}", part) for part in parts]

    def commit(self) -> int:
        """Publish everything that was staged, and put it in its places; the version."""
        version = self._claim()
        self.lease.release()
        recover(self.spark, self.root, self.folders)
        self._forget(version)
        return version

    def _claim(self) -> int:
        manifest = {"run": self.run, "since": self.since, "folders": self._entries}
        for staged, _ in self._entries:
            if not self.folders.exists(f"{self.root}/{staged}"):
                raise ContractError(f"{staged} is gone: its lease had expired")
        draft = f"{self.folder}/_manifest.json"
        self.folders.write(draft, manifest)
        version = self.since
        while True:
            for later in range(version + 1, current_version(self.folders, self.root) + 1):
                self._check_apart(later)
                version = later
            if self.folders.move(draft, _manifest(self.root, version + 1)):
                return version + 1

    def _check_apart(self, version: int) -> None:
        """Refuse if a later version replaced what this run is to replace."""
        path = _manifest(self.root, version)
        if not self.folders.exists(path):
            raise ContractError(f"{self.root}: more than {KEPT} runs have published meanwhile")
        theirs = {t for _, t in self.folders.read(path)["folders"]}
        both = sorted(theirs & {t for _, t in self._entries})
        if both:
            raise ContractError(f"{', '.join(both)}: another run has published since this one began")

    def _forget(self, version: int) -> None:
        for number in _numbers(self.folders, self.root, "json"):
            if number <= version - KEPT:
                for suffix in ("json", "done"):
                    self.folders.remove(_manifest(self.root, number, suffix))

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, *exc) -> None:
        """A run that fails before it counts takes its folder away. (A killed one can't.)"""
        self.lease.release()
        if kind is not None and issubclass(kind, Exception):
            published = any(m["run"] == self.run for _, m in _open_versions(self.folders, self.root))
            if not published:
                self.folders.remove(self.folder)
                self.folders.remove_if_empty(f"{self.root}/{LOG}")
                if self._new_root:
                    self.folders.remove_if_empty(self.root)

