"""Exact substring dedup over the whole corpus with suffix arrays of content shards.

A 50-byte window is dealt to a shard by the least hash of the 16-byte strings in it, so equal
windows meet wherever they stand. Neighbouring windows mostly share that least string, their anchor, and
travel as one segment. A first pass sends anchors only; segments whose anchor occurs in one
document alone can't repeat and stay at home. Each shard sorts the suffixes of its distinct segments.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, flat_bytes, packed, read, small_batches, staged, text_of, total_bytes
from rivulet.llm.suffix_array import permuted_prefixes, suffix_array
from rivulet.llm.textscan import grouped, mix, range_hashes, runs

MATCH, MER = 50, 16
BLOCK_BYTES, SHARD_BYTES, SLICE_BYTES = 4 << 20, 2 << 20, 1 << 20
ANCHORS = "shard int, block long, anchors binary, repeated binary"
FOUND = "block long, shard int, anchors binary"
SEGMENTS = "shard int, block long, bytes binary, lengths binary, keys binary, docs binary, starts binary, copy_docs binary, copy_starts binary, copy_ends binary"
SPANS = "block long, docs binary, starts binary, ends binary"
CLEANED = "doc_id long, doc_key long, text_hash long, n_bytes long, n_removed long, n_spans long, kept string"


def _ordered(table: pa.Table) -> pa.Table:
    """A block's rows in an order that doesn't depend on how they came: number of a document in its block."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_key", "ascending"), ("text", "ascending")]))


class Segments:
    """Runs of windows with one anchor in consecutive texts; places are relative to each text."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw) - MATCH + 1
        if n <= 0:
            self.anchor, self.doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self.first = self.start = self.end = self.doc
            return
        words = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), strides=(1,))
        low, high = words[: len(raw) - MER + 1], words[8:]
        least = mix(low * np.uint64(0x9E3779B97F4A7C15) ^ (high + (low >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F))
        width = 1
        while width * 2 <= MATCH - MER + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = MATCH - MER + 1 - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = np.flatnonzero(np.arange(n) + MATCH <= offsets[1:][doc[:n]])
        new = np.ones(len(inside), bool)
        if len(inside):
            new[1:] = (least[inside[1:]] != least[inside[:-1]]) | (inside[1:] != inside[:-1] + 1) | (doc[inside[1:]] != doc[inside[:-1]])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(inside)) - 1
        self.first = inside[at]  # place of the first window
        self.anchor, self.doc = least[self.first], doc[self.first]
        self.start = self.first - offsets[self.doc]
        self.end = inside[last] + MATCH - offsets[self.doc] if len(at) else self.start


def _shard_of(anchor: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard by the low half, and what tells anchors of a shard apart: the high half."""
    return ((anchor & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int64), (anchor >> np.uint64(32)).astype(np.uint32)


def _cuts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each run of equal keys begins and ends."""
    begin = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], len(sorted_keys))


def _send_anchors(shards: int):
    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        table = _ordered(table)
        anchors, docs = [], []
        for b in small_batches(table.combine_chunks().to_batches(), "text", SLICE_BYTES):
            s = Segments(*flat_bytes(b.column("text")))
            anchors.append(s.anchor)
            docs.append(b.column("doc_key").to_numpy()[s.doc])
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        shard, rest = _shard_of(anchor, shards)
        key = shard.astype(np.uint64) << np.uint64(32) | rest.astype(np.uint64)
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        lo, hi = _cuts(key)
        repeated = doc[lo] != doc[hi - 1] if len(lo) else np.zeros(0, bool)
        key = key[lo]
        shard, rest = (key >> np.uint64(32)).astype(np.int32), key.astype(np.uint32)
        lo, hi = _cuts(shard)
        spans = list(zip(lo, hi, strict=True))
        return pa.table(
            {
                "shard": pa.array(shard[lo]),
                "block": pa.array(np.full(len(lo), block)),
                "anchors": pa.array([packed(rest[i:j]) for i, j in spans], pa.binary()),
                "repeated": pa.array([packed(repeated[i:j]) for i, j in spans], pa.binary()),
            }
        )

    return send


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """In one shard: anchors that occur in two documents, told to the blocks that have them."""
    rest = flat_bytes(table["anchors"])[0].view(np.uint32)
    repeated = flat_bytes(table["repeated"])[0] > 0
    sizes = pc.binary_length(table["anchors"]).to_numpy() // 4
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(rest, kind="stable")
    lo, hi = _cuts(rest[order])
    wanted = np.repeat((hi - lo > 1) | np.logical_or.reduceat(repeated[order], lo) if len(lo) else np.zeros(0, bool), hi - lo)
    keep = np.sort(order[wanted])  # a block sends an anchor once, so twice means two blocks
    counts = np.bincount(row[keep], minlength=len(sizes))
    parts = np.split(rest[keep], np.cumsum(counts)[:-1])
    full = np.flatnonzero(counts)
    return pa.table(
        {
            "block": table["block"].take(pa.array(full)).combine_chunks(),
            "shard": table["shard"].take(pa.array(full)).combine_chunks(),
            "anchors": pa.array([packed(parts[i]) for i in full], pa.binary()),
        }
    )


def _send_segments(shards: int):
    def send(texts: pa.Table, found: pa.Table) -> pa.Table:
        empty = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in SEGMENTS.split(", ")])
        if not texts.num_rows or not found.num_rows:
            return empty.empty_table()
        block = texts["block"][0].as_py()
        texts = _ordered(texts)
        sizes = pc.binary_length(found["anchors"]).to_numpy() // 4
        wanted = np.repeat(found["shard"].to_numpy().astype(np.uint64), sizes) << np.uint64(32)
        wanted = np.sort(wanted | flat_bytes(found["anchors"])[0].view(np.uint32).astype(np.uint64))
        parts: dict[str, list] = {k: [] for k in ("shard", "hash", "key", "doc", "start", "end", "text")}
        base = place = 0
        chunks = []
        for b in small_batches(texts.combine_chunks().to_batches(), "text", SLICE_BYTES):
            raw, offsets = flat_bytes(b.column("text"))
            s = Segments(raw, offsets)
            shard, rest = _shard_of(s.anchor, shards)
            key = shard.astype(np.uint64) << np.uint64(32) | rest.astype(np.uint64)
            at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            on = np.flatnonzero(wanted[at] == key)
            length = (s.end - s.start)[on]
            parts["hash"].append(range_hashes(raw, s.first[on], s.first[on] + length))
            for name, values in (("shard", shard[on]), ("key", b.column("doc_key").to_numpy()[s.doc[on]]), ("doc", s.doc[on] + base), ("start", s.start[on]), ("end", s.end[on]), ("text", s.first[on] + place)):
                parts[name].append(values)
            chunks.append(raw)
            base += b.num_rows
            place += len(raw)
        p = {k: np.concatenate(v) for k, v in parts.items()}
        raw = np.concatenate(chunks)
        # Of equal segments in this block those of the least document go out; the others repeat it.
        order = np.lexsort((p["key"], p["hash"], p["shard"]))
        p = {k: v[order] for k, v in p.items()}
        new = np.ones(len(order), bool)
        new[1:] = (p["hash"][1:] != p["hash"][:-1]) | (p["shard"][1:] != p["shard"][:-1])
        least = p["key"][np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else p["key"]
        copy = p["key"] > least
        lo, hi = _cuts(p["shard"])
        out: dict[str, list] = {f.name: [] for f in empty}
        for i, j in zip(lo, hi, strict=True):
            own, copies = np.flatnonzero(~copy[i:j]) + i, np.flatnonzero(copy[i:j]) + i
            length = p["end"][own] - p["start"][own]
            into = np.repeat(p["text"][own] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            values = (int(p["shard"][i]), block, packed(raw[into]), packed(length.astype(np.int32)), packed(p["key"][own]), packed(p["doc"][own].astype(np.int32)), packed(p["start"][own].astype(np.int32)))
            values += (packed(p["doc"][copies].astype(np.int32)), packed(p["start"][copies].astype(np.int32)), packed(p["end"][copies].astype(np.int32)))
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        return pa.table(out, schema=empty)

    return send


def earlier_windows(raw: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of each segment whose windows also start in a document with a smaller key: segment, start, end."""
    ends = np.cumsum(lengths.astype(np.int64))
    begins = ends - lengths
    order, new = grouped(range_hashes(raw, begins, ends))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1  # distinct segment of each
    heads = order[new]
    least = np.minimum.reduceat(keys[order], np.flatnonzero(new))
    size = lengths[heads].astype(np.int64)
    total = np.cumsum(size)
    base = total - size
    text = raw[np.repeat(begins[heads] - base, size) + np.arange(total[-1])]
    owner = np.repeat(np.arange(len(heads)), size)
    window = np.arange(total[-1]) + MATCH <= total[owner]
    # The windows in suffix order; equal ones stand together, each sharing 50 bytes with the one before.
    sorted_places = suffix_array(text, MATCH)
    sorted_places = sorted_places[window[sorted_places]].astype(np.int64)
    shared = permuted_prefixes(text, sorted_places, MATCH)[sorted_places]
    first = np.flatnonzero(shared < MATCH)
    group = np.cumsum(shared < MATCH) - 1
    earliest = np.full(len(text), np.iinfo(np.int64).max)
    earliest[sorted_places] = np.minimum.reduceat(least[owner[sorted_places]], first)[group]
    # Each segment looks up its windows.
    windows = lengths.astype(np.int64) - MATCH + 1
    stop = np.cumsum(windows)
    segment = np.repeat(np.arange(len(lengths)), windows)
    offset = np.arange(stop[-1]) - (stop - windows)[segment]
    hit = earliest[base[which][segment] + offset] < keys[segment]
    edge = hit.copy()
    edge[1:] &= ~(hit[:-1] & (segment[1:] == segment[:-1]))
    finish = hit.copy()
    finish[:-1] &= ~(hit[1:] & (segment[1:] == segment[:-1]))
    a, b = np.flatnonzero(edge), np.flatnonzero(finish)
    return segment[a], offset[a], offset[b] + MATCH


def _sort_shard(table: pa.Table) -> pa.Table:
    def column(name: str, kind) -> np.ndarray:
        return flat_bytes(table[name])[0].view(kind)

    def rows(name: str, width: int) -> np.ndarray:
        return np.repeat(np.arange(table.num_rows), pc.binary_length(table[name]).to_numpy() // width)

    block = table["block"].to_numpy()
    lengths, docs, starts = column("lengths", np.int32), column("docs", np.int32), column("starts", np.int32)
    if len(lengths):
        segment, a, b = earlier_windows(column("bytes", np.uint8), lengths, column("keys", np.int64))
    else:
        segment = a = b = np.zeros(0, np.int64)
    to = np.concatenate((block[rows("lengths", 4)][segment], block[rows("copy_docs", 4)]))
    doc = np.concatenate((docs[segment], column("copy_docs", np.int32)))
    start = np.concatenate((starts[segment] + a, column("copy_starts", np.int32)))
    end = np.concatenate((starts[segment] + b, column("copy_ends", np.int32)))
    order = np.argsort(to, kind="stable")
    to, doc, start, end = to[order], doc[order], start[order], end[order]
    lo, hi = _cuts(to)
    parts = list(zip(lo, hi, strict=True))
    return pa.table(
        {
            "block": pa.array(to[lo].astype(np.int64)),
            "docs": pa.array([packed(doc[i:j].astype(np.int32)) for i, j in parts], pa.binary()),
            "starts": pa.array([packed(start[i:j].astype(np.int32)) for i, j in parts], pa.binary()),
            "ends": pa.array([packed(end[i:j].astype(np.int32)) for i, j in parts], pa.binary()),
        }
    )


def _remove(texts: pa.Table, spans: pa.Table) -> pa.Table:
    texts = _ordered(texts)
    docs, starts, ends = (flat_bytes(spans[c])[0].view(np.int32) if spans.num_rows else np.zeros(0, np.int32) for c in ("docs", "starts", "ends"))
    order = np.argsort(docs, kind="stable")
    docs, starts, ends = docs[order], starts[order], ends[order]
    n_bytes, n_removed, n_spans, kept = [], [], [], []
    base = 0
    for b in small_batches(texts.combine_chunks().to_batches(), "text"):
        raw, offsets = flat_bytes(b.column("text"))
        for k in range(b.num_rows):
            body = raw[offsets[k] : offsets[k + 1]]
            lo, hi = np.searchsorted(docs, (base + k, base + k + 1))
            depth = np.bincount(starts[lo:hi], minlength=len(body) + 1) - np.bincount(ends[lo:hi], minlength=len(body) + 1)
            gone = np.cumsum(depth)[: len(body)] > 0
            n_bytes.append(len(body))
            n_removed.append(int(gone.sum()))
            n_spans.append(len(runs(gone)[0]))
            kept.append(body[~gone].tobytes())
        base += b.num_rows
    return pa.table(
        {
            "doc_id": texts["doc_id"].combine_chunks(),
            "doc_key": texts["doc_key"].combine_chunks(),
            "text_hash": texts["text_hash"].combine_chunks(),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id doc_key text_hash n_bytes n_removed n_spans kept`` (bytes that stay).

    Removed is every byte covered by a 50-byte string that also starts in a document with a smaller
    id, judged on the input. Null texts are empty; rows without id come after all others and are ordered by
    their text; rows that repeat an id are judged each, and not against each other; texts under 50
    bytes stay whole; other columns are ignored; an empty table gives no rows.

    Texts are shuffled once, in blocks by a hash of the id that all three passes over them share. A
    string that stands in very many documents is sent once per block.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        doc_key(id_col, text_col).alias("doc_key"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        text_of(text_col).cast("binary").alias("text"),
    )
    size = total_bytes(docs, text_col)
    blocks, shards = max(1, size // BLOCK_BYTES), max(1, size // SHARD_BYTES)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_key"), F.lit(blocks)))
    anchors = rows.groupBy("block").applyInArrow(_send_anchors(shards), ANCHORS)
    found = anchors.groupBy("shard").applyInArrow(_repeated_anchors, FOUND)
    segments = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_send_segments(shards), SEGMENTS)
    spans = segments.groupBy("shard").applyInArrow(_sort_shard, SPANS)
    return rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_remove, CLEANED.replace("kept string", "kept binary"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that earlier documents have."""
    cleaned = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Windows as hexadecimal strings: quadratic in nothing, but heavy; meant for the small tables.
OP10_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.least < w.doc_id),
run AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hit),
mark AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM run),
span AS (SELECT doc_id, n, min(i) AS a, max(i) + 50 AS b FROM mark GROUP BY doc_id, n),
edge AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next FROM span),
piece AS (
  SELECT doc_id, string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)) || CASE WHEN next IS NULL THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept,
         sum(b - a) AS n_removed, count(*) AS n_spans
  FROM edge JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN piece USING (doc_id)
"""
