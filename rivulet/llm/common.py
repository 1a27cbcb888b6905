"""What the operators share: document keys, staging, cases for nulls and empty texts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows without an id come after all others; their key is made from the text.
NULL_KEYS = 1 << 62


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A key that is never null: the id, or beyond all ids a number made from the text."""
    made = F.lit(NULL_KEYS) + F.pmod(F.xxhash64(text_of(text_col)), F.lit(1 << 61))
    return F.coalesce(F.col(id_col).cast("long"), made)


def stage_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, a local one, which only a local session may use."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "rivulet-checkpoints")
    return f"{base.rstrip('/')}/stage-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    Cuts the lineage: a lost executor costs its own tasks only, and several readers share one
    computation. The folder goes with the checkpoint directory's own clean-up.
    """
    spark = df.sparkSession
    path = stage_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text_of(text_col))).alias("n")).first()["n"] or 0


def flat_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    texts = pc.fill_null(texts, b"" if pa.types.is_large_binary(texts.type) else "")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def table_slices(table: pa.Table, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    return small_batches(table.combine_chunks().to_batches(), column, limit)


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


# DuckDB: a one-row table whose list ``steps`` has CRC-32's 256 steps, made by its rule.
_STEP = "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)"
CRC32_STEPS = f"(SELECT list_transform(range(256), lambda i: {_STEP}) AS steps)"


def crc32_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes as a DuckDB expression over a FROM that holds ``CRC32_STEPS``."""
    values = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce({values}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
