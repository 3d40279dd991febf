"""Small files and listings in any store that Spark can reach, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Store:
    """Paths of a session: local, distributed or remote ones alike."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.conf)
        return fs, fs.makeQualified(p)

    def full(self, path: str) -> str:
        """The path with its scheme and without steps up."""
        return self._at(path)[1].toString()

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def sizes(self, path: str) -> dict[str, int]:
        """Bytes of every file below a path, by its name from there; none if the path does not exist."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return {}
        found, top = {}, p.toString().rstrip("/") + "/"
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found[f.getPath().toString().removeprefix(top)] = f.getLen()
        return found

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """The first line of a file, or of the first file with any bytes in a folder."""
        fs, p = self._at(path)
        if fs.getFileStatus(p).isDirectory():
            own = sorted(k for k, n in self.sizes(path).items() if n and not k.startswith(("_", ".")))
            if not own:
                return ""
            p = self.jvm.org.apache.hadoop.fs.Path(p, own[0])
        stream = fs.open(p)
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine() or ""
        finally:
            stream.close()

    def _replace(self, held, path: str) -> None:
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        target = self._at(path)[1]
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(held, target, how)

    def write(self, path: str, text: str) -> None:
        """Write a small file beside its place and move it there at once."""
        fs, held = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = fs.create(held, True)
        try:
            stream.write(bytearray(text, "utf-8"))
            stream.hsync()
        finally:
            stream.close()
        self._replace(held, path)

    def join(self, parts: str, path: str, first: str) -> None:
        """One file of a first line and the bytes of all files of a folder in the order of their names, streamed."""
        fs, held = self._at(f"{path}.{uuid.uuid4().hex}")
        source = self._at(parts)[0]
        stream = fs.create(held, True)
        try:
            stream.write(bytearray(first + "\n", "utf-8"))
            for name in sorted(k for k in self.sizes(parts) if not k.startswith(("_", "."))):
                part = source.open(self.jvm.org.apache.hadoop.fs.Path(f"{self.full(parts)}/{name}"))
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, 1 << 20, False)
                finally:
                    part.close()
        finally:
            stream.close()
        self._replace(held, path)

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def sha256(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
