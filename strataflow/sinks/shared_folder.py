"""Small files that appear once, on any file system that Hadoop knows (UPS-14)."""

from __future__ import annotations

import os
import uuid
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from strataflow.sinks.files import folder_uri


class SharedFolder:
    """A folder whose files are written by whoever comes first, whole or not at all, and never change."""

    def __init__(self, spark: SparkSession, folder: str | Path) -> None:
        self.uri = folder_uri(folder)
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        at = urlparse(self.uri)
        self._local = Path(unquote(at.path)) if at.scheme == "file" else None

    def _path(self, name: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.uri}/{name}" if name else self.uri)

    def _system(self) -> object:
        return self._path("").getFileSystem(self._conf)

    def names(self, sub: str) -> list[str]:
        """Files in a folder below, ascending; none if it is not there."""
        fs, at = self._system(), self._path(sub)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def read(self, name: str) -> bytes:
        stream = self._system().open(self._path(name))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def put_new(self, name: str, content: bytes) -> bool:
        """Write a file that is not there yet; False, and nothing done, if it is.

        The content is written beside it first. On a local disk a hard link gives it its name, elsewhere a rename that
        refuses to overwrite: both fail for all writers but one. A writer that dies before leaves a file that nobody reads.
        """
        partial = f"{name}.{uuid.uuid4().hex}.partial"
        if self._local is not None:
            beside, at = self._local / partial, self._local / name
            at.parent.mkdir(parents=True, exist_ok=True)
            beside.write_bytes(content)
            try:
                os.link(beside, at)
            except FileExistsError:
                return False
            finally:
                beside.unlink()
            return True
        return self._put_by_rename(name, partial, content)

    def _put_by_rename(self, name: str, partial: str, content: bytes) -> bool:
        from py4j.protocol import Py4JJavaError

        system = self._system()
        out = system.create(self._path(partial), False)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        from pyspark import SparkContext

        options = SparkContext._gateway.new_array(rename, 0)
        try:
            context.rename(self._path(partial), self._path(name), options)
        except Py4JJavaError as exc:
            system.delete(self._path(partial), False)
            if "FileAlreadyExists" in str(exc.java_exception):
                return False
            raise
        return True
