"""Objects (bytes under a URI) as a Spark sink with commit and abort.

``folio_objects`` is a Python data source: tasks write their objects under names of their own beside
the target, and a task's message tells where it listed them. Only when all tasks have ended does
the driver publish the job: it writes the job's lists down and a second, distributed step moves the
objects to their places. Objects of a failed task, of a copy of a task that lost, or of a job that
failed are never seen; a move that runs again finds its work done. Any file system that pyarrow
can open by URI will do (local and mounted folders, S3, GCS, Azure, HDFS).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "folio_objects"
SCHEMA = "key string, bytes binary"


def file_system(uri: str):
    """(file system, path in it) of a URI."""
    from pyarrow import fs

    try:
        if "://" not in uri:
            return fs.LocalFileSystem(), uri
        return fs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
        raise ValueError(f"{uri}: no file system for it") from e


@dataclass
class Written(WriterCommitMessage):
    """Where a task listed what it wrote, and how much that is."""

    listing: str
    objects: int


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, base: str, job: str):
        self.base, self.job = base.rstrip("/"), job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = file_system(self.base)
        task = TaskContext.get()
        own = f"{root}/_uncommitted/{self.job}/{task.partitionId()}-{task.taskAttemptId()}"
        moves = []
        files.create_dir(own, recursive=True)
        for batch in iterator:
            keys, blobs = batch.column("key"), batch.column("bytes")
            for i in range(batch.num_rows):
                key = keys[i].as_py()
                if key is None or not _safe(key):
                    raise ValueError(f"not the name of an object: {key!r}")
                name = f"{own}/{len(moves)}"
                with files.open_output_stream(name) as out:
                    out.write(blobs[i].as_buffer() if blobs[i].is_valid else b"")
                moves.append((name, f"{root}/{key}"))
        listing = f"{own}/moves.json"
        with files.open_output_stream(listing) as out:
            out.write("\n".join(json.dumps(m) for m in moves).encode())
        return Written(listing, len(moves))

    def commit(self, messages: list[Written | None]) -> None:
        files, root = file_system(self.base)
        with files.open_output_stream(f"{root}/_uncommitted/{self.job}/commit.json") as out:
            out.write(json.dumps([m.listing for m in messages if m is not None]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, root = file_system(self.base)
        if files.get_file_info(f"{root}/_uncommitted/{self.job}").type.name != "NotFound":
            files.delete_dir(f"{root}/_uncommitted/{self.job}")


class ObjectSink(DataSource):
    """Options: ``path``, the folder that the objects' keys are relative to; ``job``, a name of the write."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options["path"], self.options["job"])


def _safe(key: str) -> bool:
    return bool(key) and not key.startswith("/") and ".." not in key.split("/")


def _publish(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(base)
        for batch in batches:
            done = []
            for listing in batch.column(0).to_pylist():
                with files.open_input_stream(listing) as f:
                    moves = [json.loads(line) for line in f.read().decode().splitlines()]
                for name, target in moves:
                    if files.get_file_info(name).type.name == "NotFound":  # moved by an earlier attempt
                        continue
                    files.create_dir(target.rpartition("/")[0], recursive=True)
                    files.move(name, target)
                done.append(len(moves))
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["objects"])

    return run


def write_objects(rows: DataFrame, base_uri: str) -> int:
    """Write ``bytes`` under ``<base_uri>/<key>``, all or nothing; the number of objects. An object that
    exists is replaced; of rows with the same key one stays."""
    spark: SparkSession = rows.sparkSession
    job, base = uuid.uuid4().hex, base_uri.rstrip("/")
    files, root = file_system(base)
    spark.dataSource.register(ObjectSink)
    rows.select(F.col("key").cast("string").alias("key"), F.col("bytes").cast("binary").alias("bytes")).write.format(FORMAT).option("path", base).option("job", job).mode("append").save()
    with files.open_input_stream(f"{root}/_uncommitted/{job}/commit.json") as f:
        listings = json.loads(f.read())
    written = 0
    if listings:
        lists = spark.createDataFrame([(x,) for x in listings], "listing string").repartition(min(len(listings), 512))
        written = lists.mapInArrow(_publish(base), "objects long").agg(F.sum("objects")).first()[0] or 0
    files.delete_dir(f"{root}/_uncommitted/{job}")
    if not files.get_file_info(_selector(f"{root}/_uncommitted")):
        files.delete_dir(f"{root}/_uncommitted")
    return written


def _selector(path: str):
    from pyarrow import fs

    return fs.FileSelector(path, allow_not_found=True)
