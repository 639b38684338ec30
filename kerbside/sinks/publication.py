"""Publication of a set of reports: all of them replace the last run's, or none does.

Reports are written aside, below the target folder. Once all are there, a manifest names
them, and only then do they take the places of older ones, one rename each. A run that fails
before the manifest leaves all older reports as they were. One that is interrupted after it
has nothing left to compute: the next publication of the same label first puts the rest in
place. Needs a file system with rename, as every Hadoop file system has.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MANIFEST = "MANIFEST"


class Publication:
    """``with Publication(spark, path, label) as aside:`` write reports below ``aside``; they are published on leaving.

    ``optional`` names reports that are removed where this run has none.
    """

    def __init__(self, spark: SparkSession, path: str, label: str, optional: tuple[str, ...] = ()):
        self.spark, self.path, self.optional = spark, path.rstrip("/"), optional
        # Hidden from readers of the target folder.
        self.aside = f"{self.path}/.publishing-{label}"
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def __enter__(self) -> str:
        if self._exists(f"{self.aside}/{MANIFEST}"):
            self._put_in_place()
        self._remove(self.aside)
        return self.aside

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self._remove(self.aside)
            return
        names = sorted(s.getPath().getName() for s in self._files.listStatus(self._path(self.aside)))
        self._write(f"{self.aside}/{MANIFEST}", "\n".join(names))
        self._put_in_place()

    def _put_in_place(self) -> None:
        names = self._read(f"{self.aside}/{MANIFEST}").split("\n")
        for name in names:
            if self._exists(f"{self.aside}/{name}"):  # else it is in place already
                self._remove(f"{self.path}/{name}")
                self._rename(f"{self.aside}/{name}", f"{self.path}/{name}")
        for name in set(self.optional) - set(names):
            self._remove(f"{self.path}/{name}")
        self._remove(self.aside)

    def _exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def _remove(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def _rename(self, source: str, target: str) -> None:
        if not self._files.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def _write(self, path: str, text: str) -> None:
        """A file that appears whole or not at all."""
        out = self._files.create(self._path(f"{path}.tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._rename(f"{path}.tmp", path)

    def _read(self, path: str) -> str:
        row = self.spark.read.text(path, wholetext=True).first()
        return row[0]
