"""Parquet tables under one root folder: read, replace, append, commit together.

A table's rows lie in a version folder that never changes once it is written. Which
version is the table is said by a manifest, a small file of table names and
folders; manifests are numbered, and the highest one holds. A replace writes a new folder
and then one new manifest, so readers see the old table or the new one, a reader
who has begun keeps the files it began with, and a failed write changes
nothing. Several tables change at once within a ``transaction``. Versions
that no recent manifest names are removed by ``remove_old_versions``.
"""

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# files take about a third less room than by Spark's default
_COMPRESSION = "zstd"

_VERSIONS, _MANIFESTS, _APPENDED, _DRAFTS, _SCRATCH = "_versions", "_manifests", "_appended", "_drafts", "_scratch"


class TableStore:
    """Named Parquet tables in a folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._scratch: list[str] = []
        # tables written in the open transaction, not yet committed
        self._pending: dict[str, str] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        """Hadoop's file system for a path: local disk, HDFS or an object store."""
        hadoop_path = self._hadoop_path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _put_new(self, source: str, target: str) -> bool:
        """Give a finished file or folder its name in one step; False if the name is taken."""
        jvm, (fs, path) = self.spark._jvm, self._fs(target)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._hadoop_path(source), path, no_options)
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        return True

    # manifests

    def _manifest_numbers(self) -> list[int]:
        fs, folder = self._fs(self.path(_MANIFESTS))
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def _manifest(self, number: int) -> dict[str, str]:
        fs, path = self._fs(self.path(f"{_MANIFESTS}/{number:012}.json"))
        file = fs.open(path)
        try:
            return json.loads(bytes(file.readAllBytes()).decode())
        finally:
            file.close()

    def _tables(self) -> dict[str, str]:
        """Table -> folder, as committed last."""
        numbers = self._manifest_numbers()
        return self._manifest(numbers[-1]) if numbers else {}

    def _commit(self, changes: dict[str, str]) -> None:
        """One manifest with all changes. Who finds its number taken takes the next one."""
        while True:
            numbers = self._manifest_numbers()
            tables = (self._manifest(numbers[-1]) if numbers else {}) | changes
            draft = self.path(f"{_DRAFTS}/{uuid.uuid4().hex}")
            self._fs(self.path(_MANIFESTS))[0].mkdirs(self._hadoop_path(self.path(_MANIFESTS)))
            fs, path = self._fs(draft)
            file = fs.create(path, False)
            file.write(bytearray(json.dumps(tables, indent=1, sort_keys=True).encode()))
            file.close()
            if self._put_new(draft, self.path(f"{_MANIFESTS}/{(numbers[-1] if numbers else 0) + 1:012}.json")):
                return
            fs.delete(path, False)

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """Tables replaced inside appear together at the end, or not at all after an error.

        Reads inside see what was replaced inside. A transaction within another is
        a part that can fail by itself: its tables are taken back, the others stay.
        """
        outer = self._pending
        self._pending = dict(outer or {})
        try:
            yield
            done = self._pending
        except BaseException:
            for name, folder in self._pending.items():
                if (outer or {}).get(name) != folder:
                    self._delete(folder)
            self._pending = outer
            raise
        self._pending = outer
        if outer is not None:
            outer.update(done)
        elif done:
            self._commit(done)

    def remove_old_versions(self, keep: int = 2, older_than: timedelta = timedelta(days=1)) -> int:
        """Delete versions that no table has had for ``older_than``, and their manifests.

        A reader may still have a version open that was replaced a while ago, however long ago it
        was written, and a writer may not have committed its folder yet. The last ``keep``
        manifests stay in any case. Returns the number of versions deleted.
        """
        fs, versions = self._fs(self.path(_VERSIONS))
        before = self.spark._jvm.java.lang.System.currentTimeMillis() - older_than.total_seconds() * 1000

        def written(name: str) -> int:
            return fs.getFileStatus(self._hadoop_path(self.path(name))).getModificationTime()

        numbers = self._manifest_numbers()
        replaced = [n for n, later in zip(numbers, numbers[1:]) if written(f"{_MANIFESTS}/{later:012}.json") <= before]
        gone = [n for n in replaced if n not in numbers[-keep:]]
        named = {folder for n in numbers if n not in gone for folder in self._manifest(n).values()}
        removed = 0
        for status in fs.globStatus(self._hadoop_path(f"{versions.toString()}/*")) or []:
            folder = f"{_VERSIONS}/{status.getPath().getName()}"
            if folder not in named and status.getModificationTime() <= before:
                self._delete(folder)
                removed += 1
        for n in gone:
            self._delete(f"{_MANIFESTS}/{n:012}.json")
        return removed

    def _delete(self, name: str) -> None:
        fs, path = self._fs(self.path(name))
        fs.delete(path, True)

    # tables

    def folder(self, name: str) -> str | None:
        """Where the table's rows lie now; None before it is first written."""
        found = (self._pending or {}).get(name) or self._tables().get(name)
        if found is None:
            fs, appended = self._fs(self.path(f"{_APPENDED}/{name}"))
            found = f"{_APPENDED}/{name}" if fs.exists(appended) else None
        return found and self.path(found)

    def exists(self, name: str) -> bool:
        return self.folder(name) is not None

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """S6 scan by name. S10: with a schema, a table not yet written is empty."""
        folder = self.folder(name)
        if folder is None:
            if schema is None:
                raise FileNotFoundError(f"no table {name} in {self.root}")
            return self.spark.createDataFrame([], schema)
        if f"/{_APPENDED}/" in folder:
            # each batch is a folder, not a value of a column
            reader = self.spark.read.option("recursiveFileLookup", "true")
        else:
            reader = self.spark.read
        return (reader.schema(schema) if schema else reader).parquet(folder)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the whole new table, then make it the table.

        ``df`` may read the table it replaces.
        """
        folder = self.put(name, lambda path: df.write.partitionBy(*partition_by).parquet(path, compression=_COMPRESSION))
        return self.spark.read.schema(df.schema).parquet(folder)

    def put(self, name: str, write: Callable[[str], None]) -> str:
        """Let ``write`` fill a new folder, then make it the table ``name``; returns the folder."""
        folder = f"{_VERSIONS}/{name.replace('/', '.')}-{uuid.uuid4().hex}"
        try:
            write(self.path(folder))
        except BaseException:
            self._delete(folder)
            raise
        if self._pending is None:
            self._commit({name: folder})
        else:
            self._pending[name] = folder
        return self.path(folder)

    def append(self, name: str, df: DataFrame, batch: str | None = None) -> bool:
        """Add rows; the first append creates the table.

        Rows of a named ``batch`` are added once, however often the append is tried;
        returns whether they were added now. Batches of one name do not wait for each other.
        """
        target = f"{_APPENDED}/{name}/{batch or uuid.uuid4().hex}"
        fs, path = self._fs(self.path(target))
        if fs.exists(path):
            return False
        draft = f"{_DRAFTS}/{uuid.uuid4().hex}"
        try:
            df.write.parquet(self.path(draft))
            fs.mkdirs(path.getParent())
            added = self._put_new(self.path(draft), self.path(target))
        except BaseException:
            self._delete(draft)
            raise
        if not added:
            self._delete(draft)
        return added

    # scratch

    def scratch(self, label: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result and read it back.

        The written copy has a known size, survives lost executors and is not
        computed twice. It goes away with the scope it was written in, or by
        ``clear_scratch``.
        """
        path = f"{self.root}/{_SCRATCH}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=_COMPRESSION)
        self._scratch.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def scope(self) -> Iterator[None]:
        """Scratch written inside goes away at the end; what was there before stays."""
        outer, self._scratch = self._scratch, []
        try:
            yield
        finally:
            self.clear_scratch()
            self._scratch = outer

    def scratch_paths(self) -> list[str]:
        """The scratch written in the open scope."""
        return list(self._scratch)

    def clear_scratch(self) -> None:
        while self._scratch:
            self.remove_path(self._scratch.pop())

    def remove_path(self, path: str) -> None:
        """Delete a file or folder anywhere."""
        fs, target = self._fs(path)
        fs.delete(target, True)

    def version_of(self, path: str) -> tuple[int, int]:
        """Size and modification time of a file or folder anywhere."""
        fs, target = self._fs(path)
        return fs.getContentSummary(target).getLength(), fs.getFileStatus(target).getModificationTime()

    def remove(self) -> None:
        """Delete all tables of the store."""
        fs, path = self._fs(self.root)
        fs.delete(path, True)
