"""From band keys to verified classes: families of texts that share a band, exact overlap inside them, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import flat_bytes, staged, table_slices
from rivulet.llm.components import components
from rivulet.llm.textscan import grouped, mix, range_hashes, scan_words, shingles

SHINGLE = 5
BLOCK_DOCS, BLOCK_BYTES = 1000, 16 << 20
TASK_DOCS = 200  # of small families, which share tasks


def shingle_bags(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number (ascending) and hash of each shingle, repeated as often as the shingle occurs.

    A text of fewer words is one shingle; one without words is a shingle made of its bytes.
    """
    w, n = scan_words(raw, offsets), len(offsets) - 1
    hashes, first = shingles(w, size)
    doc = w.doc[first]
    few = np.flatnonzero((w.counts > 0) & (w.counts < size))
    last = np.cumsum(w.counts)
    short = range_hashes(w.hashes, last[few] - w.counts[few], last[few]) if len(few) else np.zeros(0, np.uint64)
    none = np.flatnonzero(w.counts == 0)
    bare = range_hashes(raw, offsets[none], offsets[none + 1]) if len(none) else np.zeros(0, np.uint64)
    doc = np.concatenate((doc, few, none)).astype(np.int64)
    keys = np.concatenate((hashes, short, bare))
    if len(few) or len(none):
        order = np.argsort(doc, kind="stable")
        doc, keys = doc[order], keys[order]
    return doc, keys


def counted(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and its count, in no order."""
    order, new = grouped(keys, doc)
    at = np.flatnonzero(new)
    return doc[order[at]], keys[order[at]], np.diff(np.append(at, len(order)))


def similar_groups(doc: np.ndarray, keys: np.ndarray, n: int, multiset: bool, side: np.ndarray | None = None) -> np.ndarray:
    """Least linked text number of each of n texts; linked: overlap of at least 0.8 of the union.

    In multisets the k-th occurrence of a shingle counts as an element of its own, so their overlaps are
    those of sets, and a product of matrices gives all of them. Given sides, only texts of different sides are compared.
    """
    doc, elements, times = counted(doc, keys)
    if multiset:
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        doc, elements = np.repeat(doc, times), mix(np.repeat(elements, times) + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    sizes = np.bincount(doc, minlength=n).astype(np.float64)
    _, element, seen = np.unique(elements, return_inverse=True, return_counts=True)
    shared = seen[element] > 1
    column = np.cumsum(seen > 1)[element[shared]] - 1
    row = doc[shared]
    overlap = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    columns = int(column[-1]) + 1 if len(column) else 0
    wide = max(1, min(columns, (4 << 20) // max(1, n)))
    for begin in range(0, columns, wide):
        lo, hi = np.searchsorted(column, (begin, begin + wide))
        part = np.zeros((n, wide), np.float32)
        part[row[lo:hi], column[lo:hi] - begin] = 1
        overlap += part @ part.T
    linked = 9 * overlap >= 4 * (sizes[:, None] + sizes[None, :])
    if side is not None:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, True)
    root = np.arange(n)
    while True:
        least = np.where(linked, root[None, :], n).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == root).all():
            return root
        root = least


def _link(table: pa.Table, multiset: bool) -> pa.Table:
    """Links inside one task's families, or between two blocks of one family, as id -> least id."""
    frame = table.select(["family", "id", "side"]).to_pandas()
    order = np.lexsort((frame["id"].to_numpy(), frame["family"].to_numpy()))
    table, frame = table.take(pa.array(order)), frame.iloc[order]
    family, ids, side = (frame[c].to_numpy() for c in ("family", "id", "side"))
    doc, keys, base = [], [], 0
    for piece in table_slices(table, "text"):
        d, k = shingle_bags(*flat_bytes(piece.column("text")))
        doc.append(d + base)
        keys.append(k)
        base += piece.num_rows
    doc, keys = np.concatenate(doc), np.concatenate(keys)
    roots = ids.copy()
    bounds = np.flatnonzero(np.append(True, family[1:] != family[:-1]))
    for lo, hi in zip(bounds, np.append(bounds[1:], len(ids)), strict=True):
        a, b = np.searchsorted(doc, (lo, hi))
        sides = side[lo:hi] if len(np.unique(side[lo:hi])) > 1 else None
        roots[lo:hi] = ids[lo + similar_groups(doc[a:b] - lo, keys[a:b], hi - lo, multiset, sides)]
    return pa.table({"id": pa.array(ids), "root": pa.array(roots)})


def families_of(units: DataFrame) -> tuple[DataFrame, bool]:
    """Tasks in which the ``units`` (id, n_bytes, bands) are to be compared: ``id task family side``, and whether a family is split.

    A family is what shared bands connect. A small one lies in one task with others; a large one is
    cut into blocks, and each pair of blocks is a task of its own. Ids in no family are left out.
    """
    banded = units.select("id", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last")
    edges = banded.join(leaders, "band").select(F.col("id").alias("a"), F.col("leader").alias("b"))
    members = staged(units.select("id", "n_bytes").join(components(edges).withColumnRenamed("root", "family"), "id"))
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    wanted = F.ceil(F.greatest(F.col("n") / F.lit(BLOCK_DOCS), F.col("bytes") / F.lit(BLOCK_BYTES), F.lit(1)))
    sizes = sizes.withColumn("blocks", wanted.cast("long"))
    told = sizes.agg(F.max("blocks").alias("most"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    bins = max(1, (told["bytes"] or 0) // BLOCK_BYTES, (told["n"] or 0) // TASK_DOCS)
    tasks = members.join(sizes.select("family", "blocks"), "family").withColumn("side", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")))
    tasks = tasks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.xxhash64("family", F.least("side", "other"), F.greatest("side", "other"))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("family"), F.lit(bins))).otherwise(pair)
    return tasks.select("id", task.alias("task"), "family", "side"), (told["most"] or 0) > 1


def linked_classes(texts: DataFrame, split: bool, multiset: bool) -> DataFrame:
    """``id, root`` from the tasks' texts (task family side id text): root is the least id of the class."""
    links = texts.groupBy("task").applyInArrow(lambda table: _link(table, multiset), "id long, root long")
    if split:
        links = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    return links.groupBy("id").agg(F.min("root").alias("root"))

