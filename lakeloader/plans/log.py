"""The commit log of a sink: one small JSON file per version.

A file holds all that a reader needs to know, so only the newest is read. A version
is claimed by moving a finished file onto its name, which fails if the name is taken:
of two writers that saw the same version, one commits and the other gets a
`CommitConflict`. The file `last` names a recent version, from which the newest is
found by looking for the next few names; it may be stale or missing.

The move must be atomic and refuse an existing target: a hard link on `file:`, a
rename on all others, as HDFS does it. On a store whose rename copies, let one
writer run at a time.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from lakeloader.model import CommitConflict

_LAST = "last"


class CommitLog:
    """The versions committed below `folder`."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.folder = folder
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(posixpath.join(self.folder, name) if name else self.folder)

    @staticmethod
    def _name(version: int) -> str:
        return f"{version:020d}.json"

    def _read(self, name: str) -> str | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def _listed(self) -> int:
        """The newest version by listing every name, for a log without a usable `last`."""
        folder = self._path("")
        if not self._fs.exists(folder):
            return 0
        names = [status.getPath().getName() for status in self._fs.listStatus(folder)]
        return max((int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()), default=0)

    def latest(self) -> dict | None:
        """The newest commit."""
        hint = self._read(_LAST)
        version = int(hint) if hint is not None and hint.isdigit() else self._listed()
        if version and not self._fs.exists(self._path(self._name(version))):
            version = self._listed()
        while self._fs.exists(self._path(self._name(version + 1))):
            version += 1
        return json.loads(self._read(self._name(version))) if version else None

    def claim(self, version: int, entry: dict) -> None:
        """Commit `entry` as `version`, or raise if another writer has done so."""
        self._fs.mkdirs(self._path(""))
        waiting = f"_claim-{uuid.uuid4().hex}"
        self._write(waiting, json.dumps(entry))
        try:
            if not self._moved(waiting, self._name(version)):
                raise CommitConflict(f"another run has committed version {version} of {self.folder}")
        finally:
            self._fs.delete(self._path(waiting), False)
        self._write(_LAST, str(version))

    def _moved(self, source: str, target: str) -> bool:
        source, target = self._path(source), self._path(target)
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(source.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        return self._renamed(source, target)

    def _renamed(self, source, target) -> bool:
        hadoop = self._jvm.org.apache.hadoop.fs
        # No option: an existing target is an error.
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(source, target, options)
        except Py4JJavaError as err:
            if "FileAlreadyExistsException" in err.java_exception.getClass().getName():
                return False
            raise
        return True
