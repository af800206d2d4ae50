"""Text lines in day folders, rolled into files of bounded size and committed batch by batch.

    day=<day>/<batch of the writer>-<n>.txt   lines, at most ``bytes`` a file (a longer line has a file of its own)
    _batches/<batch id>.json                  the files that a committed batch consists of

Tasks write files under names of their own and report them; the driver commits a batch by one small listing. Readers take the files
of the listings only, so a batch that failed half-way, or ran twice, counts once: its earlier files are in no listing, and go when the
batch is committed again. A file is closed when it is full and at the end of its task, so no file is open longer than a micro-batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming.query import StreamingQuery

#: Fixed value: size at which a file is full.
FULL = 128 << 20


@dataclass
class Wrote(WriterCommitMessage):
    files: list[tuple[str, int, int]]  # path below the table, bytes, lines


class RolledText(DataSource):
    """Sink ``rolled_text``: rows of (value string, day string)."""

    @classmethod
    def name(cls) -> str:
        return "rolled_text"

    def schema(self) -> str:
        return "value string, day string"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return RolledWriter(self.options["path"], int(self.options.get("bytes", FULL)))


class RolledWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, full: int):
        self.path, self.full = path, full

    def place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        files, root = self.place()
        task, open_, done = uuid.uuid4().hex, {}, []

        def close(day: str) -> None:
            out, name, size, lines = open_.pop(day)
            out.close()
            done.append((name, size, lines))

        for batch in iterator:
            for value, day in zip(batch.column("value").to_pylist(), batch.column("day").to_pylist()):
                line = (value or "").encode() + b"\n"
                if day in open_ and open_[day][2] + len(line) > self.full:
                    close(day)
                if day not in open_:
                    name = f"day={day}/{task}-{len(done) + len(open_)}.txt"
                    files.create_dir(f"{root}/day={day}", recursive=True)
                    open_[day] = [files.open_output_stream(f"{root}/{name}"), name, 0, 0]
                held = open_[day]
                held[0].write(line)
                held[2] += len(line)
                held[3] += 1
        for day in list(open_):
            close(day)
        return Wrote(done)

    def commit(self, messages: list, batchId: int) -> None:
        files, root = self.place()
        listing = f"{root}/_batches/{batchId}.json"
        files.create_dir(f"{root}/_batches", recursive=True)
        now = [f for m in messages if m for f in m.files]
        if files.get_file_info(listing).type != fs.FileType.NotFound:  # the batch ran before
            with files.open_input_stream(listing) as f:
                self.remove([tuple(x) for x in json.loads(f.read())])
        with files.open_output_stream(f"{listing}.part") as f:
            f.write(json.dumps(now).encode())
        files.move(f"{listing}.part", listing)

    def abort(self, messages: list, batchId: int) -> None:
        self.remove([f for m in messages if m for f in m.files])

    def remove(self, gone: list) -> None:
        files, root = self.place()
        for name, _, _ in gone:
            if files.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
                files.delete_file(f"{root}/{name}")


def write_rolled(lines: DataFrame, path: str, full: int = FULL) -> StreamingQuery:
    """Streams (value, day) into rolled files until the available input is used up."""
    lines.sparkSession.dataSource.register(RolledText)
    writer = lines.writeStream.format("rolled_text").option("path", f"{path}/data").option("bytes", str(full))
    return writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def batches(path: str) -> list[tuple[str, int, int]]:
    """Files of all committed batches: path below the table, bytes, lines. A listing of files, as any reader of a folder makes."""
    files, root = fs.FileSystem.from_uri(f"{path}/data")
    found = []
    for info in files.get_file_info(fs.FileSelector(f"{root}/_batches", allow_not_found=True)):
        if info.path.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                found += [tuple(x) for x in json.loads(f.read())]
    return found


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """(value, day) of the committed files."""
    names = [f"{path}/data/{name}" for name, _, _ in batches(path)]
    reader = spark.read.schema("value string, day string").option("basePath", f"{path}/data")
    return reader.text(names) if names else spark.createDataFrame([], "value string, day string")
