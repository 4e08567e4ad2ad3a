"""File-system calls through Hadoop, so that the same code serves local folders, HDFS and object stores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileInfo:
    path: str
    size: int
    modified_ms: int


class Files:
    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly under a folder, sorted; empty where it doesn't exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def walk(self, path: str, suffix: str = ".parquet") -> list[FileInfo]:
        if not self.exists(path):
            return []
        found, it = [], self._fs.listFiles(self._path(path), True)
        while it.hasNext():
            s = it.next()
            p = s.getPath()
            if p.getName().endswith(suffix) and not p.getName().startswith(("_", ".")):
                found.append(FileInfo(p.toString(), s.getLen(), s.getModificationTime()))
        return sorted(found, key=lambda f: f.path)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str, overwrite: bool = False) -> None:
        out = self._fs.create(self._path(path), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def publish(self, path: str, text: str) -> bool:
        """Writes ``text`` under a name only if the name is free; False if somebody else has it.

        The text goes to a temporary file first and is renamed without overwriting, so that readers never see half of it.
        """
        if self.exists(path):
            return False
        import uuid

        temp = f"{path}.{uuid.uuid4().hex}.tmp"
        self.write_text(temp, text)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(path).toUri(), self._conf)
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self._array(self._jvm.org.apache.hadoop.fs.Options.Rename, [none])
        try:
            context.rename(self._path(temp), self._path(path), options)
            return True
        except Exception as error:  # noqa: BLE001 - py4j wraps the Java exception
            self.delete(temp)
            if "FileAlreadyExists" in str(error):
                return False
            raise

    def _array(self, kind, items):
        from pyspark import SparkContext

        arr = SparkContext._gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            arr[i] = x
        return arr

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))
