"""Stream sinks with open, write and commit, kept as a table that only shows what was committed.

Two writers, neither of which needs a callback server:

* ``UpdateLog`` for streams in update mode (the engine's running aggregates),
  through ``DataStreamWriter.foreach``: each task opens a file of its partition
  and micro-batch, writes its rows as they come, and puts the file in place when
  it closes without an error. A micro-batch counts once the query's own commit
  log has it, so a failed one shows no rows, and one that runs again replaces
  its files: exactly one update per key and micro-batch.
* ``CommitLog``, a Python data source, for append-mode streams: tasks write
  files nobody sees yet and return their names as commit messages; the driver's
  commit of the micro-batch writes them into one manifest, an abort deletes them.

Folders are URIs that both Spark and pyarrow can open (a shared file system,
HDFS, S3). Python data sources take append-mode streams only, which is why
updates go through ``foreach``.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

CHUNK = 1 << 14         # rows of a file's row group; a task holds no more

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """``file:/x`` (as Hadoop writes it) and ``file:///x`` are the same place."""
    if path.startswith("file:/"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


class _File:
    """A parquet file written in chunks, under a name that readers skip until it is put in place."""

    def __init__(self, path: str, schema: pa.Schema):
        self.fs, self.path = _file_system(path)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.hidden = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.schema, self.rows, self.count = schema, [], 0
        self.out = pq.ParquetWriter(self.hidden, schema, filesystem=self.fs)

    def add(self, row: Row) -> None:
        self.rows.append(row.asDict(recursive=True))
        self.count += 1
        if len(self.rows) >= CHUNK:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.out.write_table(pa.Table.from_pylist(self.rows, schema=self.schema))
            self.rows = []

    def put(self) -> None:
        self._flush()
        self.out.close()
        self.fs.move(self.hidden, self.path)

    def drop(self) -> None:
        self.out.close()
        self.fs.delete_file(self.hidden)


def prepare(spark: SparkSession) -> None:
    """State off the JVM heap, snapshotted to the checkpoint folder; set before a query starts, in any session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def finish(query: StreamingQuery) -> None:
    """Wait for a query over everything available; its failure is an error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


# --- updates: foreach ------------------------------------------------------------

class UpdateLog:
    """The writer of one update-mode query: ``epoch=<micro-batch>/part-<partition>.parquet`` under ``path``."""

    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, to_arrow_schema(schema)
        self.file: _File | None = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.file = _File(f"{self.path}/epoch={epoch_id}/part-{partition_id:05d}.parquet", self.schema)
        return True

    def process(self, row: Row) -> None:
        self.file.add(row)

    def close(self, error: Exception | None) -> None:
        if self.file is not None:
            self.file.put() if error is None else self.file.drop()


def read_update_log(spark: SparkSession, path: str, checkpoint: str, schema: StructType) -> DataFrame:
    """The updates of the micro-batches that the query's commit log has, with their ``epoch``."""
    jvm = spark._jvm
    commits = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    store = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(commits)] if store.exists(commits) else []
    done = [int(n) for n in names if n.isdigit()]
    kept = StructType(schema.fields).add("epoch", "integer")
    if not store.exists(jvm.org.apache.hadoop.fs.Path(path)):
        return spark.createDataFrame([], kept)
    return spark.read.schema(kept).parquet(path).where(F.col("epoch").isin(done))


def run_to_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an update-mode stream over everything available into the log at ``path``."""
    prepare(stream.sparkSession)
    finish(stream.writeStream.outputMode("update").foreach(UpdateLog(path, stream.schema))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --- appended rows: a Python data source ------------------------------------------

@dataclass
class _Written(WriterCommitMessage):
    name: str | None
    rows: int


class _CommitLogWriter(DataSourceStreamWriter):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema = path, to_arrow_schema(schema)

    def write(self, iterator: Iterator[Row]) -> _Written:
        file, name = None, f"{uuid.uuid4().hex}.parquet"
        try:
            for row in iterator:
                file = file or _File(f"{self.path}/data/{name}", self.schema)
                file.add(row)
        except BaseException:
            if file is not None:
                file.drop()
            raise
        if file is None:
            return _Written(None, 0)
        file.put()
        return _Written(name, file.count)

    def commit(self, messages: list[_Written | None], batchId: int) -> None:
        store, root = _file_system(self.path)
        folder = f"{root}/manifests"
        store.create_dir(folder, recursive=True)
        if store.get_file_info(f"{folder}/{batchId}.json").type == fs.FileType.File:
            self.abort(messages, batchId)       # this micro-batch was committed before a restart: its rows are there
            return
        files = {m.name: m.rows for m in messages if m is not None and m.name}
        hidden = f"{folder}/_{batchId}.{uuid.uuid4().hex}"
        with store.open_output_stream(hidden) as out:
            out.write(json.dumps({"batch": batchId, "files": files}).encode())
        store.move(hidden, f"{folder}/{batchId}.json")

    def abort(self, messages: list[_Written | None], batchId: int) -> None:
        store, root = _file_system(self.path)
        for m in messages:
            if m is not None and m.name and store.get_file_info(f"{root}/data/{m.name}").type == fs.FileType.File:
                store.delete_file(f"{root}/data/{m.name}")


class CommitLog(DataSource):
    """``writeStream.format("quarry_commit_log").start(path)``"""

    @classmethod
    def name(cls) -> str:
        return "quarry_commit_log"

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return _CommitLogWriter(self.options["path"], schema)


def manifests(path: str) -> list[dict]:
    """What each committed micro-batch wrote, in their order."""
    store, root = _file_system(path)
    found = store.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    names = sorted((f.path for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("_")),
                   key=lambda p: int(p.rpartition("/")[2][:-5]))
    return [json.loads(store.open_input_stream(n).read()) for n in names]


def read_commit_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all committed micro-batches."""
    files = [f"{path}/data/{name}" for m in manifests(path) for name in m["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def run_to_commit_log(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an append-mode stream over everything available into the log at ``path``."""
    spark = stream.sparkSession
    prepare(spark)
    spark.dataSource.register(CommitLog)
    finish(stream.writeStream.outputMode("append").format(CommitLog.name())
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
