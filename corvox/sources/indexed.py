"""Lines by number: .idx files of byte offsets, a data source that reads chosen lines only, torn ends, ordered joining.

Files are opened through pyarrow's file systems, by path or URI, wherever the executors run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

#: Bytes that a scan reads at once, and lines that go to Spark at once.
BLOCK, LINES = 1 << 22, 4096


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _offsets(path: str) -> Iterator[np.ndarray]:
    """The offsets of the non-empty lines of a file, in order, and at last where it ends."""
    system, at = opened(path)
    start, read, filled = 0, 0, False
    with system.open_input_stream(at) as f:
        while block := f.read(BLOCK):
            ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10) + read
            begins = np.concatenate([[start], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
            full = ends > begins
            if len(ends) and filled:
                full[0] = True
            yield begins[full]
            read += len(block)
            if len(ends):
                start = int(ends[-1]) + 1
            filled = read > start
    if filled:
        yield np.array([start])
    yield np.array([read])


def write_indexes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, rows): writes path.idx beside each file of lines: 8-byte offsets of its non-empty lines, and of its end.

    A task reads a file block by block; a task that runs again writes the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for path in batch.column(0).to_pylist():
                system, at = opened(path + ".idx")
                n = 0
                with system.open_output_stream(at) as out:
                    for part in _offsets(path):
                        out.write(part.astype("<i8").tobytes())
                        n += len(part)
                counts.append(n - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["path", "rows"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return listed.mapInArrow(run, "path string, rows long")


@dataclass
class Rows(InputPartition):
    """Some rows of one file: from `first` to before `behind`, or those that are named."""

    path: str
    first: int
    behind: int
    named: tuple[int, ...] = ()


class LineReader(DataSourceReader):
    """Reads the chosen rows of a file with an index; conditions on `row` decide what is read at all."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.size = int(options.get("rowsperpartition", "100000"))
        self.first, self.behind = 0, None
        self.named: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802  the name is Spark's
        for f in filters:
            if getattr(f, "attribute", None) != ("row",) or not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        if isinstance(f, EqualTo):
            values = {f.value}
        elif isinstance(f, In):
            values = set(f.value)
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            return True
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            behind = f.value + isinstance(f, LessThanOrEqual)
            self.behind = behind if self.behind is None else min(self.behind, behind)
            return True
        else:
            return False
        self.named = values if self.named is None else self.named & values
        return True

    def partitions(self) -> Sequence[InputPartition]:
        system, at = opened(self.path + ".idx")
        rows = system.get_file_info(at).size // 8 - 1
        behind = rows if self.behind is None else min(rows, self.behind)
        if self.named is not None:
            kept = sorted(r for r in self.named if r is not None and self.first <= r < behind)
            return [Rows(self.path, 0, 0, tuple(kept[k : k + self.size])) for k in range(0, len(kept), self.size)] or [Rows(self.path, 0, 0)]
        return [Rows(self.path, k, min(behind, k + self.size)) for k in range(self.first, behind, self.size)] or [Rows(self.path, 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        chosen: Sequence[int] = partition.named or range(partition.first, partition.behind)
        system, at = opened(partition.path)
        with system.open_input_file(at + ".idx") as index, system.open_input_file(at) as lines:
            for k in range(0, len(chosen), LINES):
                rows = list(chosen[k : k + LINES])
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(self._lines(index, lines, rows), pa.string())], ["row", "line"])

    def _lines(self, index: pa.NativeFile, lines: pa.NativeFile, rows: list[int]) -> list[str]:
        """The lines of ascending rows; neighbouring ones are read together."""
        out: list[str] = []
        k = 0
        while k < len(rows):
            j = k
            while j + 1 < len(rows) and rows[j + 1] == rows[j] + 1:
                j += 1
            index.seek(8 * rows[k])
            offsets = np.frombuffer(index.read(8 * (j - k + 2)), "<i8")
            lines.seek(int(offsets[0]))
            block = lines.read(int(offsets[-1] - offsets[0]))
            cuts = offsets - offsets[0]
            out += [block[a:b].split(b"\n", 1)[0].removesuffix(b"\r").decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]
            k = j + 1
        return out


class IndexedLines(DataSource):
    """The data source `indexed_lines`: (row, line) of a file of lines with a .idx beside it; option path.

    Conditions on row (=, in, <, <=, >, >=) reach the reader, which seeks the chosen lines; partitions hold
    rowsPerPartition rows (100,000).
    """

    @classmethod
    def name(cls) -> str:
        return "indexed_lines"

    def schema(self) -> str:
        return "row long, line string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return LineReader(dict(self.options))


def indexed_lines(spark: SparkSession, path: str, rows_per_partition: int = 100_000) -> DataFrame:
    """(row, line) of a file with an index; filter by row to read these lines only."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IndexedLines)
    return spark.read.format("indexed_lines").option("path", path).option("rowsPerPartition", str(rows_per_partition)).load()


def trimmed_tails(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, cut): cuts the last line of each file that lacks its line end, as a writer that died leaves it.

    Whole lines are copied block by block to a new file, which then takes the place of the old one; a task that runs
    again finds nothing to cut.
    """

    def kept(system: fs.FileSystem, at: str, size: int) -> int:
        """How many bytes whole lines take."""
        with system.open_input_file(at) as f:
            end = size
            while end > 0:
                start = max(0, end - BLOCK)
                f.seek(start)
                found = f.read(end - start).rfind(b"\n")
                if found >= 0:
                    return start + found + 1
                end = start
        return 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost = []
            for path in batch.column(0).to_pylist():
                system, at = opened(path)
                size = system.get_file_info(at).size
                whole = kept(system, at, size)
                if whole < size:
                    new = f"{at}.{uuid.uuid4().hex}"
                    with system.open_input_stream(at) as old, system.open_output_stream(new) as out:
                        left = whole
                        while left:
                            block = old.read(min(BLOCK, left))
                            out.write(block)
                            left -= len(block)
                    system.move(new, at)
                lost.append(size - whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lost, pa.int64())], ["path", "cut"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return listed.mapInArrow(run, "path string, cut long")


def concatenated(spark: SparkSession, parts: Sequence[str], out: str) -> None:
    """Writes the lines of files of lines, file after file in the given order, as a folder `out` whose files are in order.

    Lines are ordered by file, block and place by a range sort, so no task holds a file; the folder appears at once,
    when all is written, and stays as it was if it is there.
    """
    order = spark.createDataFrame([(p.rpartition("/")[2], k) for k, p in enumerate(parts)], "name string, part int")
    lines = spark.read.text(list(parts)).select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    keyed = lines.join(F.broadcast(order), "name")
    new = f"{out}.{uuid.uuid4().hex}"
    ranged = keyed.repartitionByRange("part", "block", "at").sortWithinPartitions("part", "block", "at")
    ranged.select("value").write.text(new)
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = jvm.Path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(jvm.Path(out)) or not system.rename(jvm.Path(new), jvm.Path(out)):
        system.delete(jvm.Path(new), True)
        raise FileExistsError(out)
