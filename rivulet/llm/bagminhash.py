"""Near-duplicate documents: BagMinHash signatures of shingle multisets, banding, exact overlap, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, flat_bytes, read, small_batches, staged, text_of
from rivulet.llm.families import counted, families_of, linked_classes, shingle_bags
from rivulet.llm.textscan import mix

BANDS, ROWS = 32, 5  # a pair of similarity 0.8 shares no band with a chance of 3e-6
SLOTS = BANDS * ROWS
# Weights are cut into levels: exact for counts up to 512, then 256 to an octave, between which a hash of the shingle rounds without
# bias. That moves a count by 1/256 at most: at 0.8 no band is shared with a chance of 6e-6 at most.
LEVELS = np.array([*range(513)] + [m << e for e in range(1, 23) for m in range(257, 513)], np.float64)
SIGNATURE = "doc_id long, doc_key long, text_hash long, n_bytes long, f1 long, f2 long, bands array<long>"


def _gap(seed: np.ndarray) -> np.ndarray:
    """An exponential variable from a seed."""
    return -np.log1p(-((seed >> np.uint64(11)).astype(np.float64) * 2.0**-53))


def signatures(n: int, doc: np.ndarray, keys: np.ndarray, counts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures of n multisets; equal slots of two occur with the chance of their weighted Jaccard similarity.

    An element's points in weight and time are one Poisson process over all levels. It is split
    level by level: the first point falls into one half, the other half gets a later first point of its own.
    What lies above the element's weight is dropped, so levels that two sets share hold the same
    points. Each point draws a slot, and a level stops once its next point is later than all slots' first.
    """
    top = np.minimum(np.searchsorted(LEVELS, counts, side="right") - 1, len(LEVELS) - 2)
    draw = (mix(mix(keys ^ np.uint64(0xE7037ED1A0B428DB)) + top.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    top = np.minimum(top + (draw * (LEVELS[top + 1] - LEVELS[top]) < counts - LEVELS[top]), len(LEVELS) - 2)
    x = _gap(mix(keys)) / LEVELS[-1]
    leaves: list[tuple[np.ndarray, ...]] = []
    for level in range(len(LEVELS) - 1):
        on = top > level
        if not on.all():
            doc, keys, x, top = doc[on], keys[on], x[on], top[on]
        if not len(doc):
            break
        width, above = LEVELS[level + 1] - LEVELS[level], LEVELS[-1] - LEVELS[level + 1]
        seed = mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1))
        here = (mix(seed + np.uint64(1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 * (width + above) < width
        leaves.append((doc, mix(seed + np.uint64(2)), np.where(here, x, x + _gap(mix(seed + np.uint64(3))) / width), np.full(len(doc), width)))
        x = np.where(here, x + _gap(mix(seed + np.uint64(4))) / above, x)
    doc, seed, x, width = (np.concatenate(part) for part in zip(*leaves, strict=True))
    first = np.full((n, slots), np.inf)
    flat, latest = first.reshape(-1), np.full(n, np.inf)
    while len(doc):
        seed = mix(seed + np.uint64(0xA0761D6478BD642F))
        np.minimum.at(flat, doc * slots + (seed >> np.uint64(33)).astype(np.int64) % slots, x)
        live = np.zeros(n, bool)
        live[doc] = True
        live = np.flatnonzero(live)
        latest[live] = first[live].max(axis=1)
        x = x + _gap(mix(seed)) / width
        on = x < latest[doc]
        doc, seed, x, width = doc[on], seed[on], x[on], width[on]
    return mix(flat.view(np.uint64)).reshape(n, slots)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches, "text"):
        raw, offsets = flat_bytes(b.column("text"))
        n = b.num_rows
        doc, keys = shingle_bags(raw, offsets)
        sig = signatures(n, *counted(doc, keys)).reshape(n, BANDS, ROWS)
        bands = np.zeros((n, BANDS), np.uint64)
        for r in range(ROWS):
            bands = bands * np.uint64(0xD6E8FEB86659FD93) + sig[:, :, r]
        bands = mix(bands + np.arange(BANDS, dtype=np.uint64))
        # The multiset itself: order-free sums of two hashes of its shingles.
        start = np.searchsorted(doc, np.arange(n))
        f1, f2 = np.add.reduceat(mix(keys), start), np.add.reduceat(mix(keys ^ np.uint64(0x9FB21C651E98DF25)), start)
        yield pa.record_batch(
            [
                b.column("doc_id"),
                b.column("doc_key"),
                b.column("text_hash"),
                pa.array(np.diff(offsets)),
                pa.array(f1.view(np.int64)),
                pa.array(f2.view(np.int64)),
                pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).reshape(-1)), BANDS).cast(pa.list_(pa.int64())),
            ],
            names=["doc_id", "doc_key", "text_hash", "n_bytes", "f1", "f2", "bands"],
        )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id doc_key text_hash class_id``, class_id being the least key of its class.

    Two texts are linked if the multisets of their 5-word shingles overlap in at least 0.8 of their
    union; a class is what links connect. Texts with equal multisets are one class from the start and only one of
    them goes on. Documents that share a band form families; inside a family every pair is
    compared exactly, so no link is lost there. Families larger than a block are compared block by
    block in tasks of their own.

    Texts of fewer than five words are one shingle; null texts are empty, and all empty texts are
    one class. Rows without id are keyed by their text, come last and have a null ``doc_id``; rows that repeat
    an id are judged by their own text. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        doc_key(id_col, text_col).alias("doc_key"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        text_of(text_col).alias("text"),
    )
    signed = staged(rows.mapInArrow(_sign, SIGNATURE))
    exact = signed.groupBy("f1", "f2").agg(
        F.min(F.struct("doc_key", "text_hash")).alias("r"), F.any_value("bands").alias("bands"), F.any_value("n_bytes").alias("n_bytes")
    )
    exact = staged(exact.select("f1", "f2", F.col("r.doc_key").alias("id"), F.col("r.text_hash").alias("text_hash"), "n_bytes", "bands"))
    tasks, split = families_of(exact)
    texts = rows.select(F.col("doc_key").alias("id"), "text_hash", "text")
    texts = tasks.join(exact.select("id", "text_hash"), "id").join(texts, ["id", "text_hash"])
    classes = linked_classes(texts.select("task", "family", "side", "id", "text"), split, multiset=True)
    out = signed.join(exact.select("f1", "f2", "id"), ["f1", "f2"]).join(classes, "id", "left")
    return out.select("doc_id", "doc_key", "text_hash", F.coalesce("root", "id").alias("class_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class, one each, with all their columns; of repeated rows one stays."""
    kept = near_duplicates(docs, id_col, text_col).where("doc_key = class_id").select(F.col("doc_key").alias("_kept"), F.col("text_hash").alias("_hash"))
    kept = kept.groupBy("_kept").agg(F.min("_hash").alias("_hash"))
    marked = docs.withColumns({"_key": doc_key(id_col, text_col), "_text": F.xxhash64(text_of(text_col))})
    joined = marked.join(kept, (F.col("_key") == F.col("_kept")) & (F.col("_text") == F.col("_hash")))
    return joined.dropDuplicates(["_key", "_text"]).drop("_key", "_text", "_kept", "_hash")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", (F.col("doc_key") == F.col("class_id")).alias("kept"))
