"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from agorastat.sources.storage import materialize, scratch_path

__all__ = ["byte_table", "mapped", "materialize", "read", "row_mapper", "scratch_path", "segment_sums", "ship", "text_blocks", "utf8", "word_codes"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def row_mapper(
    schema: pa.Schema, function: Callable[[pa.RecordBatch], list[list]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: one batch in, the columns of one batch out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

    return run


BLOCK_BYTES = 4 << 20  # text that one step in a task holds as words


def text_blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Row ranges of about ``most`` bytes, and at least one row, as (first row, texts); null as empty."""
    texts = column.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) if len(texts) else np.zeros(0)
    first = 0
    while first < len(texts):
        begun = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, begun + most, side="right")))
        yield first, texts.slice(first, last - first)
        first = last
    pa.default_memory_pool().release_unused()


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words between ASCII white space as numbers.

    Returns where each text's words begin (with the end at last), the number of each
    word, and the distinct words those numbers stand for.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    words = lists.flatten()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # white space at either end leaves an empty word
        words = words.filter(pa.array(full))
        starts = np.concatenate([[0], np.cumsum(full)])[starts]
    coded = words.dictionary_encode()
    return starts, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, unless their search path names its folder already."""
    import os
    import shutil
    import tempfile

    import agorastat

    root = os.path.dirname(os.path.dirname(os.path.abspath(agorastat.__file__)))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="agorastat-"), "agorastat-package")
    context.addPyFile(shutil.make_archive(archive, "zip", root, "agorastat"))
    _shipped.add(context.applicationId)


def byte_table(separators: str = "", keep_case: bool = False) -> np.ndarray:
    """A table for ``mapped``: A-Z become a-z, the given ASCII characters a space."""
    table = np.arange(256, dtype=np.uint8)
    if not keep_case:
        table[65:91] += 32
    table[[ord(c) for c in separators]] = 32
    return table


def mapped(texts: pa.Array, table: np.ndarray) -> pa.Array:
    """Large strings with each byte replaced by the table; the table must leave bytes from 128 alone."""
    if not len(texts):
        return texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(table[raw]))


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches that ``starts`` bounds (one bound more than stretches); empty ones give 0."""
    ends = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return ends[starts[1:]] - ends[starts[:-1]]
