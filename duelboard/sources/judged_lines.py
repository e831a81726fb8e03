"""A data source for judgment files: ``<path>/judge=<name>/*.jsonl``, read by folder, file and line.

Each file is a partition of the scan. Only the folders of the judges asked for are
listed; they are an argument and no pushed filter, because Spark gives what one filter
has pushed to every frame made from the same load. A line that is no record stops the read with its file and number. As a
stream the source takes files in the order of their times; its offset is the last file
taken, so it stays small however many files there are.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "judged_lines"
SCHEMA = (
    "uid string, category string, model string, baseline string, games array<struct<score:string>>, "
    "judge string, file_name string, line bigint"
)


def judged_lines_source() -> type[DataSource]:
    """The source; made here so that it travels with its code to the processes that plan and read."""

    def located(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("/", "file:")) else (fs.LocalFileSystem(), path)

    def listed(path: str, judges: set[str] | None) -> list[tuple[int, str, str]]:
        """(time, judge, file) of the files of the chosen judges; the folders of others are not listed."""
        from pyarrow import fs

        store, root = located(path)
        if store.get_file_info(root).type != fs.FileType.Directory:
            return []
        if judges is None:
            folders = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory]
            folders = [f for f in folders if f.rsplit("/", 1)[-1].startswith("judge=")]
        else:
            folders = [f.path for f in store.get_file_info([f"{root}/judge={j}" for j in sorted(judges)]) if f.type == fs.FileType.Directory]
        out = []
        for folder in folders:
            for info in store.get_file_info(fs.FileSelector(folder)):
                name = info.path.rsplit("/", 1)[-1]
                if info.type == fs.FileType.File and name.endswith((".jsonl", ".json")) and not name.startswith(("_", ".")):
                    out.append((info.mtime_ns or 0, folder.rsplit("judge=", 1)[-1], info.path))
        return sorted(out)

    class JudgedFile(InputPartition):
        def __init__(self, judge: str, file: str):
            self.judge, self.file = judge, file

    def records(path: str, schema: StructType, part: JudgedFile):
        """Arrow batches of a file's lines."""
        import io

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        name, rows, numbers = part.file.rsplit("/", 1)[-1], [], []
        store, _ = located(path)

        def invalid(number: int, reason: Exception) -> ValueError:
            return ValueError(f"invalid record on line {number} of {part.file}: {reason}")

        def batch():
            try:
                return pa.RecordBatch.from_pylist(rows, kinds)
            except (pa.ArrowException, TypeError, ValueError, OverflowError):
                for number, row in zip(numbers, rows):  # which of them
                    try:
                        pa.RecordBatch.from_pylist([row], kinds)
                    except (pa.ArrowException, TypeError, ValueError, OverflowError) as exc:
                        raise invalid(number, exc) from exc
                raise

        with store.open_input_stream(part.file) as raw:
            for number, line in enumerate(io.BufferedReader(raw), 1):
                if not line.strip():
                    continue
                try:
                    record = json.loads(line)
                except ValueError as exc:
                    raise invalid(number, exc) from exc
                if not isinstance(record, dict):
                    raise invalid(number, TypeError("no object"))
                row = {**record, "judge": part.judge, "file_name": name, "line": number}
                rows.append({field.name: row.get(field.name) for field in schema.fields})
                numbers.append(number)
                if len(rows) == 1_000:
                    yield batch()
                    rows, numbers = [], []
        if rows:
            yield batch()

    class Reader(DataSourceReader):
        def __init__(self, path: str, schema: StructType, judges: set[str] | None):
            self.path, self.schema, self.judges = path, schema, judges

        def partitions(self):
            return [JudgedFile(judge, file) for _, judge, file in listed(self.path, self.judges)]

        def read(self, partition):
            return iter(()) if partition is None else records(self.path, self.schema, partition)

    class StreamReader(DataSourceStreamReader):
        def __init__(self, path: str, schema: StructType):
            self.path, self.schema = path, schema

        def initialOffset(self) -> dict:
            return {"time": -1, "file": ""}

        def latestOffset(self) -> dict:
            files = listed(self.path, None)
            return self.initialOffset() if not files else {"time": files[-1][0], "file": files[-1][2]}

        def partitions(self, start: dict, end: dict):
            after, upto = (start["time"], start["file"]), (end["time"], end["file"])
            return [JudgedFile(judge, file) for time, judge, file in listed(self.path, None) if after < (time, file) <= upto]

        def read(self, partition):
            return records(self.path, self.schema, partition)

        def commit(self, end: dict) -> None:
            pass

    class JudgedLines(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: StructType) -> DataSourceReader:
            judges = self.options.get("judges")
            return Reader(self.options["path"], schema, None if judges is None else set(json.loads(judges)))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return StreamReader(self.options["path"], schema)

    return JudgedLines


def scan_judged_lines(spark: SparkSession, path: str, judges: list[str] | None = None, schema: str | None = None) -> DataFrame:
    """Judgments with their judge, file and line, of all judges or of those named."""
    spark.dataSource.register(judged_lines_source())
    reader = spark.read.format(NAME)
    if judges is not None:
        reader = reader.option("judges", json.dumps(judges))
    return (reader if schema is None else reader.schema(schema)).load(path)


def stream_judged_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The same as a stream of files, in the order of their times; files must be moved in whole."""
    spark.dataSource.register(judged_lines_source())
    reader = spark.readStream.format(NAME)
    return (reader if schema is None else reader.schema(schema)).load(path)
