"""A numbered log of rows in a shared folder, and a streaming source that reads it by row number.

A client of a live service hands its rows to :func:`append` or :func:`pull`; they are written by
Spark and become visible all at once when their listing is renamed into ``published``. Offsets are
numbers of rows published, so any stretch can be read again as it was: a batch that failed is
replayed row by row, and a stream that stops goes on where its checkpoint is. No port, no server.

``data/append=N`` holds the rows of the N-th append, ``published/N-FIRST-ROWS`` names its
files with their row counts and the client's position after it. One client at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rillflow.sources.paths import delete, names, publish_text, read_text

FORMAT = "rillflow_feed"
ROWS_PER_PARTITION = 1_000_000


@dataclass(frozen=True)
class Part:
    """One append: its number, the number of its first row, and its rows."""

    number: int
    first: int
    rows: int

    @property
    def name(self) -> str:
        return f"{self.number:012d}-{self.first}-{self.rows}"


def _parts(listed: Sequence[str]) -> list[Part]:
    """The appends among the names of a folder, ascending; names of another form are unpublished."""
    split = [name.split("-") for name in listed]
    return sorted((Part(*map(int, s)) for s in split if len(s) == 3 and all(map(str.isdigit, s))), key=lambda p: p.number)


def _published(spark: SparkSession, path: str) -> list[Part]:
    return _parts(names(spark, f"{path}/published"))


def position(spark: SparkSession, path: str) -> str | None:
    """Where the client stood after its last append, None before any."""
    parts = _published(spark, path)
    return json.loads(read_text(spark, f"{path}/published/{parts[-1].name}"))["position"] if parts else None


def append(df: DataFrame, path: str, at: str | None = None) -> int:
    """Publish the rows of ``df`` after those that are there; how many they are.

    ``at`` is the client's own position after them. A client that starts again asks
    :func:`position`: an append whose listing is missing has not happened, and the
    next one overwrites its folder. Rows of one file keep their order. An append
    without rows publishes the position alone.
    """
    spark = df.sparkSession
    last = max(_published(spark, path), key=lambda p: p.number, default=Part(0, 0, 0))
    number, first = last.number + 1, last.first + last.rows
    folder = f"{path}/data/append={number}"
    df.write.mode("overwrite").parquet(folder)
    counts = spark.read.schema(df.schema).parquet(folder).groupBy("_metadata.file_name").count()
    files = sorted((r[0], r[1]) for r in counts.collect())  # one row per task that wrote
    part = Part(number, first, sum(n for _, n in files))
    publish_text(spark, f"{path}/published/{part.name}", json.dumps({"files": files, "position": at}))
    return part.rows


def pull(spark: SparkSession, path: str, schema: StructType | str,
         poll: Callable[[str | None], tuple[list, str]]) -> int:
    """Ask a client for the rows after the last position and publish them; how many they are.

    ``poll(position)`` gives a bounded list of rows and the position after them. One
    that fails is asked again for the same rows next time.
    """
    found, at = poll(position(spark, path))
    return append(spark.createDataFrame(found, schema), path, at) if found else 0


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Delete appends all of whose rows come before row number ``before``; the newest one stays."""
    for part in _published(spark, path)[:-1]:
        if part.first + part.rows <= before:
            delete(spark, f"{path}/published/{part.name}")
            delete(spark, f"{path}/data/append={part.number}")


def feed_rows(spark: SparkSession, path: str, schema: StructType | str,
              rows_per_partition: int = ROWS_PER_PARTITION, start: str = "earliest") -> DataFrame:
    """The log as a stream; a batch is what was published since the last one, in bounded partitions.

    ``start`` counts for a new checkpoint only: ``earliest`` is the first row still
    there, ``latest`` what comes from now on. A log without appends is a stream
    whose first batch is empty; a batch whose rows were forgotten is an error, never a gap.
    """
    if start not in ("earliest", "latest"):
        raise ValueError("start is earliest or latest")
    spark.dataSource.register(FeedSource)
    reader = spark.readStream.format(FORMAT).schema(schema)
    return reader.option("rows", rows_per_partition).option("start", start).load(path)


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):  # Hadoop writes one slash
        path = path.removeprefix("file:")
        path = "/" + path.lstrip("/")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Stretch(InputPartition):
    """Rows ``start`` up to ``end`` of one file."""

    file: str
    start: int
    end: int

    def __post_init__(self) -> None:
        super().__init__(self.file)


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> FeedReader:
        options = self.options
        return FeedReader(options["path"], schema, int(options.get("rows", ROWS_PER_PARTITION)), options.get("start"))


class FeedReader(DataSourceStreamReader):
    """Offsets ``{"row": n}``: so many rows of the log come before."""

    def __init__(self, path: str, schema: StructType, rows: int, start: str | None) -> None:
        self.path, self.schema, self.rows, self.start = path, schema, rows, start

    def _published(self) -> list[Part]:
        system, root = _file_system(self.path)
        listing = system.get_file_info(pafs.FileSelector(f"{root}/published", allow_not_found=True))
        return _parts([info.base_name for info in listing])

    def _end(self) -> int:
        return max((part.first + part.rows for part in self._published()), default=0)

    def initialOffset(self) -> dict:
        if self.start == "latest":
            return {"row": self._end()}
        return {"row": min((part.first for part in self._published()), default=0)}

    def latestOffset(self) -> dict:
        return {"row": self._end()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        system, root = _file_system(self.path)
        stretches: list[Stretch] = []
        low, high = start["row"], end["row"]
        for part in self._published():
            if part.first >= high or part.first + part.rows <= low:
                continue
            with system.open_input_stream(f"{root}/published/{part.name}") as listing:
                files = json.loads(listing.read())["files"]
            at = part.first
            for name, count in files:
                first, last = max(low - at, 0), min(high - at, count)
                for cut in range(first, last, self.rows):
                    file = f"{root}/data/append={part.number}/{name}"
                    stretches.append(Stretch(file, cut, min(cut + self.rows, last)))
                at += count
        if sum(s.end - s.start for s in stretches) != high - low:
            raise ValueError(f"rows {low} to {high} of {self.path} are not all there any more")
        return stretches or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.start >= partition.end:
            return
        system, _ = _file_system(self.path)
        form = to_arrow_schema(self.schema)
        with system.open_input_file(partition.file) as opened:
            table, at = pq.ParquetFile(opened), 0
            for group in range(table.num_row_groups):
                size = table.metadata.row_group(group).num_rows
                if at < partition.end and at + size > partition.start:
                    here = at
                    for batch in table.iter_batches(10_000, [group], form.names):
                        low, high = max(partition.start - here, 0), min(partition.end - here, len(batch))
                        if low < high:
                            columns = [batch.column(name).slice(low, high - low).cast(form.field(name).type)
                                       for name in form.names]
                            yield pa.RecordBatch.from_arrays(columns, schema=form)
                        here += len(batch)
                at += size
