"""Request bodies of a stream, each kept once: a sink that commits by the number of the micro-batch.

Every task writes its bodies to a file of its own, under a name nothing else uses. A batch counts from the moment
its list of files stands under the batch's number, which is put there in one move. A batch that is written again, after a
lost driver or a restart, finds its list and throws its new files away; files of tasks that failed are on no list.
The folder is one that the driver and all executors reach; ``pyarrow`` resolves it, so a bare path or a URI will do.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import RecordBatch
from pyarrow.fs import FileSystem, FileType
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

FORMAT = "request_bodies"

# The sink travels with its tasks, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Written(WriterCommitMessage):
    """The file of one task, and the bodies in it."""

    file: str | None
    bodies: int


class BodyWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def _place(self, *parts: str) -> tuple[FileSystem, str]:
        files, root = FileSystem.from_uri(self.path)
        return files, "/".join([root.rstrip("/"), *parts])

    def write(self, iterator: Iterator[RecordBatch]) -> Written:
        """One body per line. A task without bodies leaves no file."""
        out, bodies, name = None, 0, f"{uuid.uuid4().hex}.txt"
        try:
            for batch in iterator:
                for body in batch.column("body").to_pylist():
                    if body is None:
                        continue
                    if out is None:
                        files, folder = self._place("bodies")
                        files.create_dir(folder)
                        out = files.open_output_stream(f"{folder}/{name}")
                    out.write(body.encode() + b"\n")
                    bodies += 1
        finally:
            if out is not None:
                out.close()
        return Written(name if bodies else None, bodies)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        written = [message for message in messages if message is not None and message.file]
        files, listed = self._place("batches", f"{batchId}.json")
        if files.get_file_info(listed).type != FileType.NotFound:
            self._discard(written)
            return
        _, folder = self._place("batches")
        _, draft = self._place("drafts", f"{uuid.uuid4().hex}.json")
        files.create_dir(folder)
        files.create_dir(draft.rsplit("/", 1)[0])
        with files.open_output_stream(draft) as out:
            for message in written:
                out.write(json.dumps({"batch": batchId, "file": message.file, "bodies": message.bodies}).encode() + b"\n")
        files.move(draft, listed)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._discard([message for message in messages if message is not None and message.file])

    def _discard(self, written: list[Written]) -> None:
        for message in written:
            files, place = self._place("bodies", message.file)
            files.delete_file(place)


class BodySink(DataSource):
    """``writeStream.format("request_bodies").option("path", folder)`` for frames with a string column ``body``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: StructType, overwrite: bool) -> BodyWriter:
        if "body" not in schema.names:
            raise ValueError("request bodies need a column 'body'")
        return BodyWriter(self.options["path"])


def start_bodies(bodies: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write every body of a stream once; a null one is left out."""
    bodies.sparkSession.dataSource.register(BodySink)
    writer = bodies.select(F.col("body").cast("string").alias("body")).writeStream.format(FORMAT)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """``batch, body`` of all batches that count; other files are read past."""
    listed = spark.read.schema("batch long, file string, bodies long").json(f"{path}/batches")
    lines = spark.read.text(f"{path}/bodies").select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    return lines.join(listed.select("batch", "file"), "file").select("batch", "body")
