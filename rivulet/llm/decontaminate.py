"""Benchmark decontamination with a positional inverted index that is distributed by document.

Each document's row holds the postings of all its words: distinct words, times, positions. The index does not depend on the benchmark
and is built once; blocks of test windows are then looked for one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import flat_bytes, packed, read, small_batches, staged, text_of
from rivulet.llm.textscan import scan_words, shingles

WINDOW = 13
SLOP = 2
BLOCK_WINDOWS = 200_000
CUT_WINDOWS, CANDIDATES = 50_000, 1 << 20
TERM_BYTES = 4 << 20
INDEX = "doc_id long, text_hash long, n_words long, terms binary, times binary, times_high binary, positions binary, positions_high binary"
WINDOWS = "item_id string, n int, words binary"
MATCHES = "doc_id long, text_hash long, starts array<int>, ends array<int>, items array<string>, near_items array<string>"


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id n words``: every window of ``window`` consecutive words, as hashes; an item of fewer words is one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", 1 << 20):
            w = scan_words(*flat_bytes(b.column("text")))
            _, first = shingles(w, window)
            few = np.flatnonzero((w.counts > 0) & (w.counts < window))
            first = np.concatenate((first, np.cumsum(w.counts)[few] - w.counts[few]))
            n = np.minimum(w.counts[w.doc[first]], window)
            for at in range(0, len(first), CUT_WINDOWS):
                f, size = first[at : at + CUT_WINDOWS], n[at : at + CUT_WINDOWS]
                yield pa.record_batch(
                    [
                        b.column("item_id").take(pa.array(w.doc[f])),
                        pa.array(size.astype(np.int32)),
                        pa.array([packed(w.hashes[i : i + k]) for i, k in zip(f, size, strict=True)], pa.binary()),
                    ],
                    names=["item_id", "n", "words"],
                )

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), text_of("text").alias("text"))
    return rows.mapInArrow(cut, WINDOWS)


class WindowBlock:
    """One block of windows: ranks of their words in a sorted vocabulary, in groups of equal length."""

    def __init__(self, rows: pa.Table):
        self.ids, item = np.unique(np.array(rows["item_id"].to_pylist(), object).astype(str), return_inverse=True)
        size = rows["n"].to_numpy()
        raw, _ = flat_bytes(rows["words"])
        self.vocabulary, ranks = np.unique(raw.view(np.uint64), return_inverse=True)
        begin = np.cumsum(size) - size
        self.groups: list[tuple[np.ndarray, np.ndarray]] = []  # ranks of the words of each window; its item
        for n in np.unique(size):
            on = np.flatnonzero(size == n)
            self.groups.append((ranks[begin[on][:, None] + np.arange(n)].astype(np.int32), item[on].astype(np.int32)))


def window_blocks(items: DataFrame, window: int, block_windows: int) -> Iterator[WindowBlock]:
    """The windows in blocks of about ``block_windows``, those of a long item in many; one block at a time is brought to the driver."""
    windows = staged(item_windows(items, window).distinct())
    blocks = max(1, -(-windows.count() // block_windows))
    block = F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks))
    for b in range(blocks):
        yield WindowBlock(windows.where(block == b).toArrow())


def _halves(name: str, values: np.ndarray, bits: int) -> dict[str, np.ndarray]:
    """The low bits and the high bits of numbers in two columns: the high ones are nearly always 0 and take no room in a file."""
    low, high = (np.uint8, np.uint32) if bits == 8 else (np.uint16, np.uint16)
    return {name: (values & ((1 << bits) - 1)).astype(low), f"{name}_high": (values >> bits).astype(high)}


def _joined(b: pa.RecordBatch, name: str, bits: int) -> np.ndarray:
    low, high = (np.uint8, np.uint32) if bits == 8 else (np.uint16, np.uint16)
    parts = flat_bytes(b.column(name))[0].view(low), flat_bytes(b.column(f"{name}_high"))[0].view(high)
    return parts[0].astype(np.int64) | (parts[1].astype(np.int64) << bits)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Positional postings, one row per document: distinct words in ascending order of their hash, how often each occurs, where.

    A document's row is self-contained, so the index is spread as its documents are and searching needs no shuffle.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        text_of(text_col).alias("text"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            w = scan_words(*flat_bytes(b.column("text")))
            order = np.argsort(w.hashes, kind="stable")
            order = order[np.argsort(w.doc[order], kind="stable")]
            doc, term = w.doc[order], w.hashes[order]
            new = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1]))) if len(term) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(term))).astype(np.int32)
            place = (order - np.repeat(np.cumsum(w.counts) - w.counts, w.counts)).astype(np.int32)
            cut = np.cumsum(np.bincount(doc[new], minlength=b.num_rows))[:-1]
            columns = {"terms": term[new], **_halves("times", times, 8), **_halves("positions", place, 16)}
            cuts = {c: np.cumsum(w.counts)[:-1] if c.startswith("positions") else cut for c in columns}
            yield pa.record_batch(
                [b.column("doc_id"), b.column("text_hash"), pa.array(w.counts.astype(np.int64))]
                + [pa.array([packed(x) for x in np.split(v, cuts[c])], pa.binary()) for c, v in columns.items()],
                names=["doc_id", "text_hash", "n_words", *columns],
            )

    return staged(rows.mapInArrow(scan, INDEX))


def _intersect(lists: np.ndarray, begins: np.ndarray, ends: np.ndarray, room: int, groups: list, n_terms: int, slop: int) -> tuple[np.ndarray, ...]:
    """Exact phrases as (start, end, item), phrases with every word within ``slop`` of its place as (start, item).

    ``lists`` holds the postings as ``term * room + place`` in ascending order, so the list of a term is one stretch of it. For each window
    the list of its rarest term, shifted by its offset, is intersected with that of the next rarest, and so on. Windows lie
    in one text, from its place in ``begins`` to that in ``ends``.
    """
    bounds = np.searchsorted(lists, np.arange(n_terms + 1) * room)
    length = np.diff(bounds)
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    for ranks, item in groups:
        n = ranks.shape[1]
        present = np.flatnonzero((length[ranks] > 0).all(axis=1))
        if not len(present):
            continue
        ranks, item = ranks[present], item[present]
        rarity = np.argsort(length[ranks], axis=1, kind="stable")
        rows = np.arange(len(ranks))
        lead = ranks[rows, rarity[:, 0]]
        for part in np.split(rows, np.flatnonzero(np.diff(np.cumsum(length[lead]) * (2 * slop + 1) // CANDIDATES)) + 1):
            counts = length[lead[part]]
            window = np.repeat(part, counts)
            posting = np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(bounds[lead[part]], counts)
            start = lists[posting] - lead[window].astype(np.int64) * room - rarity[window, 0]
            shift = np.tile(np.arange(-slop, slop + 1), len(start))
            window, start = np.repeat(window, 2 * slop + 1), np.repeat(start, 2 * slop + 1) + shift
            exact = shift == 0
            text = np.searchsorted(begins, start, side="right") - 1
            fits = (text >= 0) & (start + n <= ends[text])
            window, start, exact = window[fits], start[fits], exact[fits]
            for k in range(1, n):
                if not len(window):
                    break
                offset = rarity[window, k]
                want = ranks[window, offset].astype(np.int64) * room + start + offset
                least, most = want - np.minimum(slop, start + offset), want + np.minimum(slop, room - 1 - start - offset)
                at = np.minimum(np.searchsorted(lists, least), len(lists) - 1)
                close = (lists[at] >= least) & (lists[at] <= most)
                window, start, exact, want = window[close], start[close], exact[close], want[close]
                at = np.minimum(np.searchsorted(lists, want[exact]), len(lists) - 1)
                exact[exact] = lists[at] == want[exact]
            for out, more in zip(found, (start[exact], start[exact] + n, item[window[exact]], start, item[window]), strict=True):
                out.append(more)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def search_index(index: DataFrame, block: WindowBlock, slop: int = SLOP) -> DataFrame:
    """Documents with matches: word ranges of exact phrases, items found exactly, items found in proximity."""
    vocabulary, groups, ids = block.vocabulary, block.groups, np.array(block.ids, object)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "terms", TERM_BYTES):
            raw, at = flat_bytes(b.column("terms"))
            term, doc = raw.view(np.uint64), np.repeat(np.arange(b.num_rows), np.diff(at) // 8)
            times, places = _joined(b, "times", 8), _joined(b, "positions", 16)
            if not len(vocabulary) or not len(term):
                continue
            rank = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
            known = vocabulary[rank] == term
            n_words = b.column("n_words").to_numpy()
            begins = np.cumsum(n_words + slop + 1) - (n_words + slop + 1)  # room between texts: no word stands near another text's
            room = int((n_words + slop + 1).sum())
            on = np.repeat(known, times)
            lists = np.repeat((rank * room + begins[doc])[known], times[known]) + places[on]
            lists.sort()
            s, e, it, near_at, near_it = _intersect(lists, begins, begins + n_words, room, groups, len(vocabulary), slop)
            near_doc = np.searchsorted(begins, near_at, side="right") - 1
            if not len(near_at):
                continue
            doc = np.searchsorted(begins, s, side="right") - 1
            order = np.argsort(doc, kind="stable")
            doc, s, e, it = doc[order], s[order] - begins[doc[order]], e[order] - begins[doc[order]], it[order]
            found = np.unique(near_doc)  # an exact phrase is also one in proximity
            order = np.argsort(near_doc, kind="stable")
            near_doc, near_it = near_doc[order], near_it[order]
            lo, hi = np.searchsorted(doc, found), np.searchsorted(doc, found, side="right")
            nlo, nhi = np.searchsorted(near_doc, found), np.searchsorted(near_doc, found, side="right")
            yield pa.record_batch(
                [
                    b.column("doc_id").take(pa.array(found)),
                    b.column("text_hash").take(pa.array(found)),
                    pa.array([s[i:j] for i, j in zip(lo, hi, strict=True)], pa.list_(pa.int32())),
                    pa.array([e[i:j] for i, j in zip(lo, hi, strict=True)], pa.list_(pa.int32())),
                    pa.array([list(ids[np.unique(it[i:j])]) for i, j in zip(lo, hi, strict=True)], pa.list_(pa.string())),
                    pa.array([list(ids[np.unique(near_it[i:j])]) for i, j in zip(nlo, nhi, strict=True)], pa.list_(pa.string())),
                ],
                names=["doc_id", "text_hash", "starts", "ends", "items", "near_items"],
            )

    return index.mapInArrow(search, MATCHES)


@F.pandas_udf(T.LongType())
def covered(starts: pd.Series, ends: pd.Series) -> pd.Series:
    """Number of places in the union of ranges."""

    def one(s: np.ndarray, e: np.ndarray) -> int:
        if s is None or not len(s):
            return 0
        order = np.argsort(s, kind="stable")
        s, e = s[order].astype(np.int64), np.maximum.accumulate(e[order].astype(np.int64))
        reached = np.concatenate(([s[0]], e[:-1]))
        return int(np.maximum(0, e - np.maximum(s, reached)).sum())

    return pd.Series([one(s, e) for s, e in zip(starts, ends, strict=True)], dtype="int64")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    slop: int = SLOP,
    block_windows: int = BLOCK_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id text_hash n_words n_hit items near_items contaminated``.

    Words are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. ``n_hit`` counts words in any exact occurrence of a
    window of ``window`` consecutive words of an item (an item of fewer words is one window);
    ``near_items`` are items with a window whose words all stand within ``slop`` words of their
    places. Contaminated: hits make up at least a twentieth of the words. Null texts have no words,
    repeated rows are judged alike, a null id stays null; items without words or an empty benchmark
    match nothing; other columns are ignored.
    """
    index = build_index(docs, id_col, text_col)
    # One block of the benchmark's windows at a time is held, and what it finds is written.
    found = []
    for block in window_blocks(benchmark, window, block_windows):
        found.append(staged(search_index(index, block, slop).dropDuplicates(["doc_id", "text_hash"])))
    merged = reduce(DataFrame.unionAll, found).groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    merged = merged.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), covered("starts", "ends").alias("n_hit"), "items", "near_items")
    none = F.array().cast("array<string>")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    out = index.select("doc_id", "text_hash", "n_words").join(merged, same, "left")
    out = out.withColumns(
        {
            "n_hit": F.coalesce("n_hit", F.lit(0)),
            "items": F.coalesce("items", none),
            "near_items": F.coalesce("near_items", none),
        }
    ).drop("_id", "_hash")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **how).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    same = docs[id_col].eqNullSafe(F.col("bad_id")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("bad_hash"))
    return docs.join(bad, same, "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against all benchmark items."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.size("near_items").cast("long").alias("n_near_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


OP5_SQL = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM dwin JOIN win USING (n, key)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
rare AS (
  SELECT item_id, n, ww, arg_min(k, df * 100 + k) AS k, arg_min(t, df * 100 + k) AS t FROM (
    SELECT item_id, n, key, string_split(key, ' ') AS ww, unnest(range(1, n + 1)) AS k, unnest(string_split(key, ' ')) AS t FROM win
  ) LEFT JOIN (SELECT t, count(*) AS df FROM (SELECT unnest(w) AS t FROM dw) GROUP BY t) USING (t)
  GROUP BY item_id, n, key, ww HAVING bool_and(df IS NOT NULL)
), near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM (
    SELECT doc_id, w, item_id, n, ww, pos - k + unnest(range(1 - {SLOP}, 2 + {SLOP})) AS start
    FROM (SELECT doc_id, w, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS pos FROM dw) JOIN rare USING (t)
  ) WHERE start >= 1 AND start + n - 1 <= len(w)
    AND len(list_filter(range(0, n), lambda j: NOT list_contains(w[greatest(1, start + j - {SLOP}):start + j + {SLOP}], ww[j + 1]))) = 0
  GROUP BY doc_id
),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(n_near_items, 0)::BIGINT AS n_near_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN near USING (doc_id)
"""
