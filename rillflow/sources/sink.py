"""A sink for notes and originals: files appear whole or not at all, and the manifest tells what was written, also after a failure."""

from __future__ import annotations

import contextlib
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NOTE = "path STRING, content BINARY, course_id STRING, item_id STRING, updated_at STRING, has_md BOOLEAN"
MANIFEST_ROW = "course_id STRING, item_id STRING, updated_at STRING, has_md BOOLEAN, path STRING, at BIGINT"
_MANIFEST = "_manifest"


@dataclass
class Written(WriterCommitMessage):
    """What one task put in place."""

    files: int


class NoteWriter(DataSourceWriter):
    """Tasks stage their files, and put them in place only when they have all of them.

    A file is moved to its place by a rename, over what was there. After its last file a task adds
    its part to the run's manifest. A task that fails puts nothing in place and no part; tasks that
    were done before stay done, as their parts say. The driver only clears the run's staging
    folder and leaves a mark: it sees counts, never files.
    """

    def __init__(self, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("the notes sink needs a path")
        self.uri, self.run = options["path"], options.get("run") or uuid.uuid4().hex
        self.at = int(options.get("at", "0"))

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.uri) if "://" in self.uri or self.uri.startswith("/") else (fs.LocalFileSystem(), self.uri)

    def _put(self, store: fs.FileSystem, path: str, content: bytes) -> None:
        store.create_dir(posixpath.dirname(path), recursive=True)
        with store.open_output_stream(path) as f:
            f.write(content)

    def write(self, rows: Iterator[Row]) -> Written:
        store, root = self._store()
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, 0)
        stage = f"{root}/.staging-{self.run}-{attempt}"  # no folder is shared, so no task can remove another's
        said, staged = [], {}
        try:
            for row in rows:
                path = posixpath.normpath(row["path"])
                if path.startswith(("/", "../")) or path in (".", "..") or path.split("/")[0] == _MANIFEST:
                    raise ValueError(f"not a path inside the sink: {row['path']}")
                if row["content"] is not None:  # nothing to write: the manifest still knows the item
                    staged[path] = f"{stage}/{len(staged)}" if path not in staged else staged[path]
                    self._put(store, staged[path], bytes(row["content"]))
                said.append({"path": path, "at": self.at} | {n: row[n] for n in ("course_id", "item_id", "updated_at", "has_md")})
            for path, at in staged.items():
                store.create_dir(posixpath.dirname(f"{root}/{path}"), recursive=True)
                store.move(at, f"{root}/{path}")
            if said:
                self._put(store, f"{stage}/manifest", "".join(json.dumps(s) + "\n" for s in said).encode())
                store.create_dir(f"{root}/{_MANIFEST}/run={self.run}", recursive=True)
                store.move(f"{stage}/manifest", f"{root}/{_MANIFEST}/run={self.run}/part-{part:05d}.json")
        finally:
            if store.get_file_info(stage).type != fs.FileType.NotFound:
                store.delete_dir(stage)
        return Written(len(staged))

    def _end(self, mark: str, files: int) -> None:
        store, root = self._store()
        for left in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if left.base_name.startswith(f".staging-{self.run}-"):  # of a worker that was killed
                with contextlib.suppress(FileNotFoundError):  # its task may still be alive and clear it too
                    store.delete_dir(left.path)
        self._put(store, f"{root}/{_MANIFEST}/run={self.run}/_{mark}", str(files).encode())

    def commit(self, messages: list[Written | None]) -> None:
        self._end("COMPLETE", sum(m.files for m in messages if m))

    def abort(self, messages: list[Written | None]) -> None:
        self._end("INCOMPLETE", sum(m.files for m in messages if m))


class NoteSink(DataSource):
    """``df.write.format("notes").mode("append").option("path", ...)``; options ``run`` (a name) and ``at`` (a number that grows from run to run)."""

    @classmethod
    def name(cls) -> str:
        return "notes"

    def schema(self) -> str:
        return NOTE

    def writer(self, schema: StructType, overwrite: bool) -> NoteWriter:
        missing = {"path", "content", "course_id", "item_id", "updated_at", "has_md"} - set(schema.names)
        if overwrite or missing:
            raise ValueError(f"append rows with {NOTE}" + (f"; missing: {sorted(missing)}" if missing else ""))
        return NoteWriter(dict(self.options))


def write_notes(notes: DataFrame, path: str, run: str, at: int) -> None:
    """Notes and originals (``NOTE``; text content may be a string) into files under ``path``."""
    spark = notes.sparkSession
    spark.dataSource.register(NoteSink)
    rows = notes.select("path", F.col("content").cast("binary").alias("content"), "course_id", "item_id", "updated_at", "has_md")
    rows.write.format("notes").mode("append").option("path", path).option("run", run).option("at", str(at)).save()


def written_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest over all runs: of each item what the latest run says (ties: the least path). Rows are never removed."""
    parts = spark.read.schema(MANIFEST_ROW).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.json").json(f"{path}/{_MANIFEST}")
    last = Window.partitionBy("course_id", "item_id").orderBy(F.desc("at"), "path")
    return parts.withColumn("nth", F.row_number().over(last)).where("nth = 1").drop("nth")
