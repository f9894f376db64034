"""Files and scratch tables by Hadoop paths, which mean the same to the driver and to every executor.

A path without a scheme lies in the session's default file system: the local disk in local mode, the shared store on a cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def qualified(self, path: str) -> str:
        """The path with its scheme and without . or .."""
        fs, where = self._at(path)
        return fs.makeQualified(where).toString()

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files of a folder."""
        fs, where = self._at(path)
        return fs.getContentSummary(where).getLength()

    def listed(self, path: str) -> list[str]:
        """The file itself, or a folder's files in order; hidden ones and marks of success are left out."""
        fs, where = self._at(path)
        if fs.getFileStatus(where).isFile():
            return [path]
        found, out = fs.listFiles(where, True), []
        while found.hasNext():
            file = found.next().getPath()
            if not file.getName().startswith((".", "_SUCCESS")):
                out.append(file.toString())
        return sorted(out)

    def read(self, path: str) -> bytes:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, data: bytes) -> None:
        """Written under another name first, so that a reader sees the whole file or none."""
        part = f"{path}.part"
        self.concat([], part, data)
        self.replace(part, path)

    def concat(self, parts: list[str], target: str, head: bytes = b"") -> None:
        """A new file: head, then the parts."""
        fs, where = self._at(target)
        sink = fs.create(where, True)
        try:
            sink.write(bytearray(head))
            for part in parts:
                other, source = self._at(part)
                stream = other.open(source)
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, sink, self.conf, False)
                finally:
                    stream.close()
        finally:
            sink.close()

    def replace(self, source: str, target: str) -> None:
        fs, where = self._at(source)
        _, new = self._at(target)
        if fs.exists(new):
            fs.delete(new, True)
        if not fs.rename(where, new):
            raise OSError(f"{source} cannot be renamed to {target}")

    def remove(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def remove_at_exit(self, path: str) -> None:
        fs, where = self._at(path)
        fs.mkdirs(where)
        fs.deleteOnExit(where)

    def fingerprint(self, path: str) -> str:
        """SHA-256 of a file, or of a folder's relative paths and files in order; ValueError if the store finds one damaged."""
        digest = self.jvm.java.security.MessageDigest.getInstance("SHA-256")
        root = self.qualified(path)
        for file in self.listed(path):
            if file != path:
                digest.update(bytearray(self.qualified(file).removeprefix(root).lstrip("/").encode()))
            fs, where = self._at(file)
            stream = self.jvm.java.security.DigestInputStream(fs.open(where), digest)
            try:
                self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, self.jvm.java.io.OutputStream.nullOutputStream(), 1 << 16, False)
            except Py4JJavaError as e:
                if "ChecksumException" in e.java_exception.getClass().getName():
                    raise ValueError(f"{file} changed: the store finds it damaged") from e
                raise
            finally:
                stream.close()
        return bytes(digest.digest()).hex()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only where ``spark.checkpoint.dir`` is unset (tests) a folder is chosen
    here: a temporary one in local mode, the warehouse on a cluster.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local"):
        return _LOCAL_SCRATCH.setdefault(context.applicationId, tempfile.mkdtemp(prefix="quillmatch-"))
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_quillmatch_scratch"


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no lineage.

    They are there for what reads them lazily and go when the session's JVM ends, or earlier by drop().
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.files = Files(spark)
        self.files.remove_at_exit(self.root)
        self.made = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._quillmatch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Removes tables that save() returned and that nothing reads any more."""
        for df in tables:
            self.files.remove(df._quillmatch_path)
