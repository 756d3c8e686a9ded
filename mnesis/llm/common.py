"""What the operators of this subpackage share: the shared folder, Arrow slices, word codes and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task handles at a time, whatever the size of the batches that Spark sends.
SLICE_BYTES = 4 << 20
#: How bulky tables of bytes are written that are read once or twice: small, in long pages.
ZSTD = {"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20), "parquet.enable.dictionary": "false"}


@lru_cache(maxsize=1)
def own_folder(master: str) -> str:
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors see. Where that is unset, a temporary folder will do if
    Spark runs on this machine alone, as in tests; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or own_folder(spark.sparkContext.master)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df written as a table to the shared folder and read again: its lineage ends there, and a lost executor costs no
    work that was done before. The results that are made of it read it when they run, so it stays; the folder is for
    scratch data and is cleared as a whole."""
    path = shared_folder(df.sparkSession, name)
    df.write.options(compression=compression, **(ZSTD if compression == "zstd" else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice has at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words between ASCII white space: the code of each, the word of each code, and where each text's codes start
    and end. Null texts have none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(full).as_py():  # leading or trailing white space gives empty words
        mask = full.to_numpy(zero_copy_only=False)
        offsets = np.concatenate(([0], np.cumsum(mask)))[offsets]
        flat = flat.filter(full)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, offsets


def word_codes(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    codes, words, offsets = coded_words(texts)
    return codes, plain_list(words), offsets


def plain_list(words: pa.Array) -> list[str]:
    """words.to_pylist(), much faster, for words without line feeds."""
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()
    return whole.split("\n") if len(words) else []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def crc32_of(column) -> F.Column:
    """crc32 of a column's text; null counts as empty."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
