"""First lines of files, from their first bytes, as a Spark data source."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from leafwave.sources.sbf_source import list_files, open_store

HEAD_BYTES = 1_024
#: Files a task opens.
FILES_A_TASK = 200
SCHEMA = pa.schema([("path", pa.string()), ("size", pa.int64()), ("line", pa.string())])


@dataclass
class Files(InputPartition):
    files: list[tuple[str, int]]


class HeadsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["path"])

    def partitions(self) -> list[Files]:
        files = [f for given in self.paths for f in list_files(given)]
        return [Files(files[i : i + FILES_A_TASK]) for i in range(0, len(files), FILES_A_TASK)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        lines = []
        for path, _ in partition.files:
            store, inside = open_store(path)
            with store.open_input_stream(inside) as f:
                lines.append(f.read(HEAD_BYTES).split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace"))
        paths, sizes = zip(*partition.files) if partition.files else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(lines, pa.string())], schema=SCHEMA)


class HeadsSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return "path string, size bigint, line string"

    def reader(self, schema) -> HeadsReader:
        return HeadsReader(self.options)


def read_heads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size, line) of every file; an empty one has an empty line."""
    spark.dataSource.register(HeadsSource)
    return spark.read.format("file_heads").load(json.dumps([path] if isinstance(path, str) else list(path)))
