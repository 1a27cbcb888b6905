"""Substring dedup by paragraphs: MinHash bands, exact Jaccard, components; pasted passages by their pieces.

A paragraph is a line of at least ``MIN_WORDS`` words. Paragraphs whose sets of 5-word shingles
reach a Jaccard similarity of 0.8 are linked, and of each class of linked paragraphs the first one stays.
A passage pasted into the middle of a longer paragraph makes neither paragraph similar to the other. So the
word sequence of each text is also cut where a hash of two words is the least around; these pieces
depend on nothing outside a few words, a shared passage is made of the same pieces everywhere, and an
equal piece (similarity 1) is a paragraph of its own. Where the neighbours of a repeated piece differ between its
places, a passage ends near by: there the piece with one word more, two words more, ... of its surroundings is counted
in the same way, so a passage goes up to its very ends, whichever earlier document has it. Stretches of ``STRETCH`` words or more go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import doc_key, flat_bytes, packed, read, small_batches, staged, table_slices, text_of, total_bytes
from rivulet.llm.families import SHINGLE, families_of, linked_classes
from rivulet.llm.textscan import Words, grouped, mix, range_hashes, runs, scan_words, shingles

SIMILARITY, RECALL, ROWS = 0.8, 0.999, 3
MIN_WORDS, STRETCH = 20, 20
PIECE_RADIUS, PIECE_MIN = 4, 4
LEFT, RIGHT = 1, 2
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 32 << 20
UNITS = "id long, doc_key long, text_hash long, start int, n_bytes long, f1 long, f2 long, bands array<long>"
PIECES = "shard int, block long, pieces binary, keys binary, twice binary, before binary, after binary"
FIRSTS = "block long, pieces binary, keys binary, forks binary"
CLEANED = "doc_id long, doc_key long, text_hash long, n_paragraphs long, n_removed long, removed_bytes long, kept string"


def tune_bands(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands with which a pair of the given similarity shares one with the given chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def paragraphs(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of enough words: text number, begin and end in ``w.data``, first word and word after the last."""
    stops = np.sort(np.concatenate((np.flatnonzero(w.data == 10), w.begins[1:] - 1, [len(w.data)])))
    begins = np.concatenate(([0], stops[:-1] + 1))
    lo, hi = np.searchsorted(w.starts, begins), np.searchsorted(w.starts, stops)
    on = hi - lo >= MIN_WORDS
    begins, stops, lo, hi = begins[on], stops[on], lo[on], hi[on]
    return np.searchsorted(w.begins, begins, side="right") - 1, begins, stops, lo, hi


def _signed(n_bands: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, n_bands * ROWS + 1, dtype=np.uint64))
        for b in small_batches(batches, "text"):
            w = scan_words(*flat_bytes(b.column("text")))
            doc, begins, stops, lo, hi = paragraphs(w)
            if not len(doc):
                continue
            hashes, first = shingles(w, SHINGLE)
            # Shingles of a paragraph are those that begin and end in it.
            a, z = np.searchsorted(first, lo), np.searchsorted(first, hi - SHINGLE + 1)
            size = z - a
            of = np.repeat(np.arange(len(doc)), size)
            keys = hashes[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            start = np.cumsum(size) - size
            sig = np.stack([np.minimum.reduceat(mix(keys ^ s), start) for s in seeds], axis=1).reshape(len(doc), n_bands, ROWS)
            bands = np.zeros((len(doc), n_bands), np.uint64)
            for r in range(ROWS):
                bands = bands * np.uint64(0xD6E8FEB86659FD93) + sig[:, :, r]
            bands = mix(bands + np.arange(n_bands, dtype=np.uint64))
            order, new = grouped(keys, of)  # the set: each shingle once
            once = np.sort(order[new])
            keys, of = keys[once], of[once]
            start = np.searchsorted(of, np.arange(len(doc)))
            f1, f2 = np.add.reduceat(mix(keys), start), np.add.reduceat(mix(keys ^ np.uint64(0x9FB21C651E98DF25)), start)
            key, text_hash = b.column("doc_key").to_numpy()[doc], b.column("text_hash").to_numpy()[doc]
            place = (begins - w.begins[doc]).astype(np.int32)
            unit = mix(mix(key.view(np.uint64)) + text_hash.view(np.uint64) + place.astype(np.uint64)) >> np.uint64(1)
            yield pa.record_batch(
                [
                    pa.array(unit.view(np.int64)),
                    pa.array(key),
                    pa.array(text_hash),
                    pa.array(place),
                    pa.array(stops - begins),
                    pa.array(f1.view(np.int64)),
                    pa.array(f2.view(np.int64)),
                    pa.FixedSizeListArray.from_arrays(pa.array(bands.view(np.int64).reshape(-1)), n_bands).cast(pa.list_(pa.int64())),
                ],
                names=["id", "doc_key", "text_hash", "start", "n_bytes", "f1", "f2", "bands"],
            )

    return sign


def pieces(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content-defined pieces of the word sequences: first word, word after the last, hash."""
    n = len(w.hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pair = mix(w.hashes[:-1] * np.uint64(3) + w.hashes[1:])
    edge = np.zeros(n, bool)
    if len(pair) > 2 * PIECE_RADIUS:
        windows = np.lib.stride_tricks.sliding_window_view(pair, 2 * PIECE_RADIUS + 1)
        middle = pair[PIECE_RADIUS:-PIECE_RADIUS]
        # The least of its surroundings; of equal ones the first, so a run of one word is not cut at each word.
        left = np.lib.stride_tricks.sliding_window_view(pair, PIECE_RADIUS)[: len(middle)].min(axis=1)
        edge[PIECE_RADIUS : PIECE_RADIUS + len(middle)] = (windows.min(axis=1) == middle) & (left > middle)
        inside = w.doc[: len(middle)] == w.doc[n - len(middle) :]  # all these words are of one text
        edge[PIECE_RADIUS : PIECE_RADIUS + len(middle)] &= inside
    edge[0] = True
    edge[1:] |= w.doc[1:] != w.doc[:-1]
    lo = np.flatnonzero(edge)
    hi = np.append(lo[1:], n)
    long = hi - lo >= PIECE_MIN
    lo, hi = lo[long], hi[long]
    return lo, hi, range_hashes(w.hashes, lo, hi)


def _cuts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], len(sorted_keys))


def _neighbours(w: Words, lo: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of the hashes of the pieces before and after each piece in its text; 1 where there is none."""
    short = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(2)
    before, after = np.ones(len(h), np.uint32), np.ones(len(h), np.uint32)
    same = w.doc[lo[1:]] == w.doc[lo[:-1]]
    before[1:][same], after[:-1][same] = short[:-1][same], short[1:][same]
    return before, after


def _agreed(values: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The value of each group of neighbours in the array, 0 where they differ or one is 0."""
    least, most = np.minimum.reduceat(values, lo), np.maximum.reduceat(values, lo)
    return np.where(least == most, least, np.uint32(0))


def _to_shards(block: int, shards: int, piece: np.ndarray, key: np.ndarray, before: np.ndarray, after: np.ndarray) -> pa.Table:
    """A block's distinct pieces: the least document that has each, whether it was found twice here, its neighbours."""
    shard = (piece % np.uint64(shards)).astype(np.int32)
    order = np.lexsort((key, piece, shard))
    piece, key, shard = piece[order], key[order], shard[order]
    lo, hi = _cuts(piece)
    before, after = (_agreed(v[order], lo) if len(lo) else v for v in (before, after))
    piece, shard, key, twice = piece[lo], shard[lo], key[lo], hi - lo > 1
    lo, hi = _cuts(shard)
    spans = list(zip(lo, hi, strict=True))
    columns = {"pieces": piece, "keys": key, "twice": twice, "before": before, "after": after}
    return pa.table(
        {"shard": pa.array(shard[lo]), "block": pa.array(np.full(len(lo), block))}
        | {c: pa.array([packed(v[i:j]) for i, j in spans], pa.binary()) for c, v in columns.items()}
    )


def _send_pieces(shards: int):
    def send(table: pa.Table) -> pa.Table:
        found = []
        for b in table_slices(table, "text"):
            w = scan_words(*flat_bytes(b.column("text")))
            lo, _, h = pieces(w)
            found.append((h, b.column("doc_key").to_numpy()[w.doc[lo]], *_neighbours(w, lo, h)))
        return _to_shards(table["block"][0].as_py(), shards, *(np.concatenate(c) for c in zip(*found, strict=True)))

    return send


def _send_ends(shards: int):
    """As ``_send_pieces``, for the pieces with more and more words of their surroundings, where the surroundings differ."""

    def send(texts: pa.Table, told: pa.Table) -> pa.Table:
        known, _, forks = _known(told)
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for b in table_slices(texts, "text"):
            w = scan_words(*flat_bytes(b.column("text")))
            lo, _, h = ends(w, *pieces(w), known, forks)
            found.append((h, b.column("doc_key").to_numpy()[w.doc[lo]]))
        piece, key = (np.concatenate(c) for c in zip(*found, strict=True))
        none = np.zeros(len(piece), np.uint32)
        block = (texts if texts.num_rows else told)["block"][0].as_py()
        return _to_shards(block, shards, piece, key, none, none)

    return send


def _first_documents(table: pa.Table) -> pa.Table:
    """In one shard: pieces found more than once, told to the blocks that have them.

    Told are the least document that has a piece, and on which sides its neighbours are not the same everywhere.
    """
    columns = {"pieces": np.uint64, "keys": np.int64, "before": np.uint32, "after": np.uint32}
    piece, key, before, after = (flat_bytes(table[c])[0].view(t) for c, t in columns.items())
    sizes = pc.binary_length(table["pieces"]).to_numpy() // 8
    row = np.repeat(np.arange(len(sizes)), sizes)
    twice = flat_bytes(table["twice"])[0] > 0
    order = np.lexsort((key, piece))
    lo, hi = _cuts(piece[order])
    group = np.repeat(np.arange(len(lo)), hi - lo)
    least, fork = np.empty(len(key), np.int64), np.empty(len(key), np.uint8)
    wanted = np.zeros(0, bool)
    if len(lo):
        wanted = ((hi - lo > 1) | np.logical_or.reduceat(twice[order], lo))[group]
        least[order] = key[order][lo][group]
        sides = LEFT * (_agreed(before[order], lo) == 0) + RIGHT * (_agreed(after[order], lo) == 0)
        fork[order] = sides.astype(np.uint8)[group]
    keep = np.sort(order[wanted])
    counts = np.bincount(row[keep], minlength=len(sizes))
    cut = np.cumsum(counts)[:-1]
    full = np.flatnonzero(counts)
    told = {"pieces": piece, "keys": least, "forks": fork}
    parts = {c: np.split(v[keep], cut) for c, v in told.items()}
    return pa.table(
        {"block": table["block"].take(pa.array(full)).combine_chunks()}
        | {c: pa.array([packed(v[i]) for i in full], pa.binary()) for c, v in parts.items()}
    )


def _known(told: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces told to a block in ascending order, with the first document and the sides of each."""
    known, least, forks = (flat_bytes(told[c])[0].view(t) for c, t in (("pieces", np.uint64), ("keys", np.int64), ("forks", np.uint8)))
    order = np.argsort(known)
    return known[order], least[order], forks[order]


def _look_up(known: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes are known, and their places among the known ones."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    on = np.flatnonzero(known[at] == h)
    return on, at[on]


def ends(
    w: Words, lo: np.ndarray, hi: np.ndarray, h: np.ndarray, known: np.ndarray, forks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known pieces with 1, 2, ... words more on the sides given by ``forks``: first word, word after the last, hash.

    Equal words around two places of a piece end inside the next piece of either text, or at most as many
    words beyond it as the choice of its cut depends on; so that many are tried, to the ends of the text at most.
    """
    on, at = _look_up(known, h)
    sides = np.zeros(len(h), np.uint8)
    sides[on] = forks[at]
    last = np.cumsum(w.counts)
    begin, end = (last - w.counts)[w.doc[lo]], last[w.doc[lo]]
    same = w.doc[lo[1:]] == w.doc[lo[:-1]]
    from_, to = begin.copy(), end.copy()
    from_[1:][same] = lo[:-1][same]
    to[:-1][same] = hi[1:][same]
    left = np.where(sides & LEFT, lo - np.maximum(begin, from_ - PIECE_RADIUS - 1), 0)
    right = np.where(sides & RIGHT, np.minimum(end, to + PIECE_RADIUS + 1) - hi, 0)
    more_left = np.arange(1, left.sum() + 1) - np.repeat(np.cumsum(left) - left, left)
    more_right = np.arange(1, right.sum() + 1) - np.repeat(np.cumsum(right) - right, right)
    lo2 = np.concatenate((np.repeat(lo, left) - more_left, np.repeat(lo, right)))
    hi2 = np.concatenate((np.repeat(hi, left), np.repeat(hi, right) + more_right))
    # A run that two neighbouring pieces both grow into is one place, not two.
    order = np.lexsort((hi2, lo2))
    lo2, hi2 = lo2[order], hi2[order]
    once = np.append(True, (lo2[1:] != lo2[:-1]) | (hi2[1:] != hi2[:-1])) if len(lo2) else np.zeros(0, bool)
    lo2, hi2 = lo2[once], hi2[once]
    return lo2, hi2, range_hashes(w.hashes, lo2, hi2)


def _earlier(w: Words, keys: np.ndarray, lo: np.ndarray, h: np.ndarray, known: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which of the word runs are in an earlier document, or at an earlier place of their own one."""
    on, at = _look_up(known, h)
    own, first = keys[w.doc[lo[on]]], least[at]
    earlier = first < own
    same = np.flatnonzero(first == own)  # the first document: the first of equal runs stays
    order = same[np.lexsort((lo[on[same]], h[on[same]], w.doc[lo[on[same]]]))]
    text, piece = w.doc[lo[on[order]]], h[on[order]]
    earlier[order[1:][(text[1:] == text[:-1]) & (piece[1:] == piece[:-1])]] = True
    return on[earlier]


def _repeated_words(w: Words, keys: np.ndarray, firsts: tuple[np.ndarray, ...], further: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether each word lies in a stretch of runs that an earlier document, or an earlier place of this one, has."""
    n = len(w.hashes)
    lo, hi, h = pieces(w)
    lo2, hi2, h2 = ends(w, lo, hi, h, firsts[0], firsts[2])
    hit, hit2 = _earlier(w, keys, lo, h, *firsts[:2]), _earlier(w, keys, lo2, h2, *further[:2])
    opened = np.bincount(np.concatenate((lo[hit], lo2[hit2])), minlength=n + 1)
    closed = np.bincount(np.concatenate((hi[hit], hi2[hit2])), minlength=n + 1)
    gone = np.cumsum(opened - closed)[:n] > 0
    change = np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))) != 0
    change[1:-1] |= np.diff(w.doc) != 0
    edges = np.flatnonzero(change)
    short = np.flatnonzero(np.diff(edges) < STRETCH)
    for a, b in zip(edges[short], edges[short + 1], strict=True):
        gone[a:b] = False
    return gone


def _remove(texts: pa.Table, side: pa.Table) -> pa.Table:
    firsts, further = _known(side.filter(pc.equal(side["part"], "pieces"))), _known(side.filter(pc.equal(side["part"], "ends")))
    marked = side.filter(pc.equal(side["part"], "paragraphs"))
    spans: dict[tuple[int, int], set[int]] = {}
    for key, text_hash, start in zip(*(marked[c].to_pylist() for c in ("doc_key", "text_hash", "start")), strict=True):
        spans.setdefault((key, text_hash), set()).add(start)
    out: dict[str, list] = {c: [] for c in ("n_paragraphs", "n_removed", "removed_bytes", "kept")}
    for b in table_slices(texts, "text"):
        w = scan_words(*flat_bytes(b.column("text")))
        keys, hashes = b.column("doc_key").to_numpy(), b.column("text_hash").to_numpy()
        gone = np.flatnonzero(_repeated_words(w, keys, firsts, further))
        # A removed word goes with what follows it up to the next word of the text.
        bounds = np.append(w.begins, len(w.data) + 1)
        until = np.minimum(np.append(w.starts[1:], len(w.data) + 1), bounds[1:][w.doc] - 1)
        room = len(w.data) + 2
        cut = np.cumsum(np.bincount(w.starts[gone], minlength=room) - np.bincount(until[gone], minlength=room)) > 0
        doc, begins, stops, _, _ = paragraphs(w)
        for d, s, e in zip(doc, begins, stops, strict=True):
            if s - w.begins[d] in spans.get((int(keys[d]), int(hashes[d])), ()):
                cut[s : e + 1] = True
        out["n_paragraphs"].extend(np.bincount(doc, minlength=b.num_rows).tolist())
        for d in range(b.num_rows):
            body, flags = w.data[bounds[d] : bounds[d + 1] - 1], cut[bounds[d] : bounds[d + 1] - 1]
            out["n_removed"].append(len(runs(flags)[0]))
            out["removed_bytes"].append(int(flags.sum()))
            out["kept"].append(body[~flags].tobytes().decode())
    columns = {c: texts[c].combine_chunks() for c in ("doc_id", "doc_key", "text_hash")}
    columns |= {c: pa.array(out[c], pa.int64()) for c in ("n_paragraphs", "n_removed", "removed_bytes")}
    return pa.table(columns | {"kept": pa.array(out["kept"], pa.string())})


def _cut_paragraphs(texts: pa.Table, wanted: pa.Table) -> pa.Table:
    """The texts of the wanted paragraphs (doc_key, text_hash, start)."""
    by: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, (key, text_hash, start) in enumerate(zip(*(wanted[c].to_pylist() for c in ("doc_key", "text_hash", "start")), strict=True)):
        by.setdefault((key, text_hash), []).append((start, i))
    rows, cut = [], []
    for b in table_slices(texts, "text"):
        for key, text_hash, text in zip(b.column("doc_key").to_pylist(), b.column("text_hash").to_pylist(), b.column("text"), strict=True):
            places = by.pop((key, text_hash), None)
            if places:
                body = text.as_py().encode()
                for start, i in places:
                    rows.append(i)
                    cut.append(body[start : body.find(b"\n", start) if body.find(b"\n", start) >= 0 else len(body)].decode())
    picked = wanted.take(pa.array(rows, pa.int64()))
    return pa.table({c: picked[c].combine_chunks() for c in ("task", "family", "side", "id")} | {"text": pa.array(cut, pa.string())})


def dedup_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id doc_key text_hash n_paragraphs n_removed removed_bytes kept``.

    ``kept`` is the text without paragraphs that are similar to an earlier one, and without passages
    that an earlier document, or an earlier place of the same one, has; ``n_removed`` counts the stretches taken out. Order is that of the
    id, then of the place. Null texts are empty; rows without id come last, keyed by their text; rows that
    repeat an id are each judged by their text, and pieces of theirs don't count against each other; very short
    texts have no paragraphs and stay; other columns are ignored; an empty table gives no rows.

    One paragraph of each set of equal ones goes through banding; families of colliding paragraphs
    are compared exactly, in blocks. Texts are shuffled in blocks by a hash of the id.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        doc_key(id_col, text_col).alias("doc_key"),
        F.xxhash64(text_of(text_col)).alias("text_hash"),
        text_of(text_col).alias("text"),
    )
    size = total_bytes(docs, text_col)
    n_blocks, shards = max(1, size // BLOCK_BYTES), max(1, size // SHARD_BYTES)
    block = F.pmod(F.xxhash64("doc_key"), F.lit(n_blocks))
    units = staged(rows.mapInArrow(_signed(tune_bands()), UNITS))
    place = F.struct("doc_key", "text_hash", "start", "id")
    exact = units.groupBy("f1", "f2").agg(F.min(place).alias("first"), F.any_value("n_bytes").alias("n_bytes"), F.any_value("bands").alias("bands"))
    exact = staged(exact.select("f1", "f2", "first.*", "n_bytes", "bands"))
    tasks, split = families_of(exact)
    wanted = tasks.join(exact.select("id", "doc_key", "text_hash", "start"), "id").withColumn("block", block)
    rows = rows.withColumn("block", block)
    texts = rows.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        _cut_paragraphs, "task long, family long, side long, id long, text string"
    )
    classes = staged(linked_classes(texts, split, multiset=False))
    classed = exact.join(classes, "id", "left").select("f1", "f2", "doc_key", "text_hash", "start", F.coalesce("root", "id").alias("class"))
    firsts = classed.groupBy("class").agg(F.min(F.struct("doc_key", "text_hash", "start")).alias("first"))
    firsts = classed.select("f1", "f2", "class").join(firsts, "class").select("f1", "f2", "first")
    repeats = units.select("doc_key", "text_hash", "start", "f1", "f2").join(firsts, ["f1", "f2"])
    repeats = repeats.where(F.struct("doc_key", "text_hash", "start") != F.col("first")).withColumn("block", block)

    sent = rows.groupBy("block").applyInArrow(_send_pieces(shards), PIECES)
    found = staged(sent.groupBy("shard").applyInArrow(_first_documents, FIRSTS))
    sent = rows.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_send_ends(shards), PIECES)
    further = sent.groupBy("shard").applyInArrow(_first_documents, FIRSTS)
    side = repeats.select("block", F.lit("paragraphs").alias("part"), "doc_key", "text_hash", "start")
    for part, told in (("pieces", found), ("ends", further)):
        side = side.unionByName(told.withColumn("part", F.lit(part)), allowMissingColumns=True)
    return rows.groupBy("block").cogroup(side.groupBy("block")).applyInArrow(_remove, CLEANED)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated paragraphs and passages."""
    cleaned = dedup_paragraphs(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_paragraphs", "n_removed", "removed_bytes", F.col("kept").alias("text"))
