"""Token ids in Parquet: list columns with delta encoding, bounded row groups and page indexes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .bpe import WordBpe, _byte_letters, encoded
from .common import more_fields

_open: dict[str, "LibraryBpe"] = {}

#: Bytes of a row group and a data page; rows of a page, so that a page index entry covers few documents.
ROW_GROUP, PAGE, PAGE_ROWS = 8 << 20, 256 << 10, 500


class LibraryBpe(WordBpe):
    """The same pre-tokens, each encoded by the tokenizers library, many at a time."""

    most_pieces, batch_bytes = 1_000_000, 8_000_000

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.letters = {b: c for b, c in enumerate(_byte_letters())}
        self.encoder = Tokenizer(Tokenizer.from_file(path).model)
        self.encoder.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(self.letters[10])
        self.ends_word = np.array([bool(self.end) and t.endswith(self.end) for t in self.tokens])

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets); no word's bytes hold a line end, so its letter parts the words, and each ends in one token."""
        joined = "\n".join(words).encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.encoder.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        offsets = np.concatenate([[0], np.flatnonzero(self.ends_word[ids]) + 1])
        if len(offsets) != len(words) + 1:
            raise ValueError("the tokenizer file doesn't mark the ends of words")
        return ids, offsets


def opened(path: str) -> LibraryBpe:
    """The library's tokenizer of a file, read once by each worker."""
    if path not in _open:
        _open[path] = LibraryBpe(path)
    return _open[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, item: str = "doc_id", text: str = "text", end: int = 1, parts: int | None = None) -> None:
    """Writes (item, n_tokens, ids) of each whole text, `end` appended, in ascending item order, to Parquet files.

    Files, and rows in them, rise with the item: rows are range-partitioned and sorted before they are tokenized, so
    only texts are moved. Ids are delta-encoded and bit-packed, which leaves a codec little to find, in small pages with
    column and offset indexes, and row groups are bounded, so a reader of some items or of the counts alone touches few
    bytes. Null items come
    first; rows of equal items follow the order of their texts. A null text has no tokens but the end.
    """
    slim = docs.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    ranged = slim.repartitionByRange(parts, "item") if parts else slim.repartitionByRange("item")
    ordered = ranged.sortWithinPartitions("item", "text")
    tokens = encoded(ordered, tokenizer, "text", "ids", end, opened).select("item", F.size("ids").cast("long").alias("n_tokens"), "ids")
    writer = tokens.write.option("compression", "none")
    for key, value in (
        ("parquet.block.size", ROW_GROUP),
        ("parquet.page.size", PAGE),
        ("parquet.page.row.count.limit", PAGE_ROWS),
        ("parquet.enable.dictionary", "false"),
        ("parquet.writer.version", "PARQUET_2_0"),
    ):
        writer = writer.option(key, value)
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The stored rows (item, n_tokens, ids), those of a condition if one is given, with their place: `file` and `row`.

    Conditions and column choices reach the files: row groups and pages out of range, and ids not asked for, are not read.
    """
    rows = spark.read.schema("item long, n_tokens long, ids array<int>").parquet(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    rows = rows.select("item", "n_tokens", "ids", number.alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows if where is None else rows.where(where)


def with_starts(rows: DataFrame) -> DataFrame:
    """Stored rows with `start`, the ids of all documents before each one, in the order of files and items.

    The ids in each file are summed, the sums (one row for each file) are added up along the files, and rows are
    placed inside their own file only.
    """
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    along = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("file", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, "file")
    return placed.withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("before")


def with_checksums(rows: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """rows with `out`, the CRC-32 of their ids as little-endian unsigned 32-bit integers, in the place of the ids."""
    slim = rows.drop(out)
    schema = more_fields(slim.drop(ids), f"`{out}` long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = np.asarray(lists.values).astype("<u4")
            cuts = lists.offsets.to_pylist()
            sums = [None if not ok else zlib.crc32(flat[i:j].tobytes()) for i, j, ok in zip(cuts, cuts[1:], lists.is_valid().to_pylist())]
            left = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in left), pa.array(sums, pa.int64())], [*left, out])

    return slim.mapInArrow(run, schema)
