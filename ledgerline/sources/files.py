"""Small files and folders on any Hadoop file system, handled by the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Lists, small texts and the one atomic step that publishing needs (:meth:`claim`)."""

    def __init__(self, spark: SparkSession):
        self._gateway, self._jvm = spark.sparkContext._gateway, spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self._jvm.org.apache.hadoop.fs.Path(path)
        return path, path.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        path, fs = self._at(path)
        return fs.exists(path)

    def names(self, folder: str) -> list[str]:
        """Names of what the folder holds (nothing if there is no such folder), sorted."""
        path, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, path: str) -> str:
        path, fs = self._at(path)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new small file; its folders are made."""
        path, fs = self._at(path)
        stream = fs.create(path, False)
        stream.write(text.encode())
        stream.close()

    def delete(self, path: str) -> None:
        path, fs = self._at(path)
        fs.delete(path, True)

    def join(self, parts: list[str], path: str, head: bytes = b"") -> None:
        """One new file: head, then the parts' bytes in order; the parts are gone after.

        Where the file system can put files one behind the other (HDFS) no
        byte is moved; elsewhere they are copied through a buffer.  The file
        appears under its name when it is complete.
        """
        target, fs = self._at(path)
        draft = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}.draft")
        sources = [self._at(p)[0] for p in parts]
        stream = fs.create(draft, True)
        try:
            stream.write(head)
            if fs.getUri().getScheme() != "hdfs":
                for source in sources:
                    part = fs.open(source)
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, stream, 1 << 20, False)
                    part.close()
        finally:
            stream.close()
        if fs.getUri().getScheme() == "hdfs" and sources:
            listed = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Path, len(sources))
            for i, source in enumerate(sources):
                listed[i] = source
            fs.concat(draft, listed)
        fs.delete(target, False)
        fs.rename(draft, target)

    def claim(self, folder: str, name: str) -> bool:
        """Renames a complete, non-empty folder to ``name``, unless that name is taken: False then.

        Of several writers that claim one name, exactly one gets it wherever
        the file system renames atomically and without replacing, as HDFS and
        local disks do; an object store needs a committer that does so.
        """
        source, fs = self._at(folder)
        target, _ = self._at(name)
        fs.mkdirs(target.getParent())
        try:
            if fs.getUri().getScheme() == "file":  # Hadoop's local rename copies into a folder that is there
                how = self._gateway.new_array(self._jvm.java.nio.file.CopyOption, 1)
                how[0] = self._jvm.java.nio.file.StandardCopyOption.ATOMIC_MOVE
                local = [self._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (source, target)]
                self._jvm.java.nio.file.Files.move(*local, how)
            else:
                never_replace = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self._conf).rename(source, target, never_replace)
        except Py4JJavaError:
            if fs.exists(source) and fs.exists(target):
                return False
            raise
        return True
