"""Ranked lexical search: an inverted index in document shards, searched by Block-Max MaxScore.

A shard is a run of documents with a few million words. For every term it holds one row: postings (document, times)
in blocks of 128, compressed, and for each block its last document and the most times and the least length in it, from which
follows a bound of what any of its documents can score. Nothing in it depends on the queries or on counts of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import flat_bytes, read, small_batches, staged, text_of
from rivulet.llm.textscan import ALNUM, ALNUM_MASK, mix

TOP = 50
SHARD_WORDS = 4_000_000
WINDOW_WORDS = 500_000
BLOCK = 128
ITEM_BLOCK = 256
INDEX = "shard long, term long, df long, total long, heads binary, body binary"
_HEAD = 4  # last document, end in the body, most times, least length
_SHORT = 64
_BYTES = mix(np.arange(_SHORT << 8, dtype=np.uint64) + np.uint64(0x51ED270B))


def scan_terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of consecutive texts in order, and the number of terms of each text.

    The hash is a sum over the bytes of random numbers that depend on the byte and on its place in the term.
    """
    n = len(offsets) - 1
    data = np.insert(raw, offsets[1:-1], 0x20) if n > 1 else raw
    begins = offsets[:-1] + np.arange(n)
    mask = np.zeros(len(data) + 2, np.int8)
    mask[1:-1] = ALNUM_MASK[data]
    edges = np.flatnonzero(np.diff(mask))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    counts = np.bincount(np.searchsorted(begins, starts, side="right") - 1, minlength=n)[:n]
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    keys = (place << 8) + ALNUM[data[mask[1:-1] > 0]]
    if lengths.max() <= _SHORT:
        values = _BYTES[keys]
    else:
        values = mix(keys.astype(np.uint64) + np.uint64(0x51ED270B))
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), counts


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^35 in groups of seven bits, lowest first; the bytes, and where each number ends."""
    sizes = 1 + sum((values >= (1 << s)).astype(np.int64) for s in (7, 14, 21, 28))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        long = sizes > k
        if not long.any():
            break
        bits = (values[long] >> (7 * k)) & 127
        out[ends[long] - sizes[long] + k] = bits + 128 * (sizes[long] > k + 1)
    return out, ends


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], last[:-1] + 1))
    if len(last) == len(data):
        return data.astype(np.int64)
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    at = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def _shard(number: int, ids: list[pa.Array], counts: np.ndarray, terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of one shard: that of its documents (no term), then one per term."""
    id_column = pa.concat_arrays(ids)
    missing = np.asarray(id_column.is_null())
    packed_ids = np.asarray(id_column.fill_null(0)).astype(np.int64).tobytes() + counts.astype(np.int32).tobytes()
    columns = [[number], [None], [int((counts > 0).sum())], [int(counts.sum())], [missing.astype(np.uint8).tobytes()], [packed_ids]]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = ["shard", "term", "df", "total", "heads", "body"]
    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    if not len(terms):
        return
    order = np.argsort(terms, kind="stable")  # documents stay in order
    terms, docs = terms[order], np.repeat(np.arange(len(counts)), counts)[order]
    new_term = np.concatenate(([True], terms[1:] != terms[:-1]))
    first = np.flatnonzero(new_term | np.concatenate(([True], docs[1:] != docs[:-1])))
    times = np.diff(np.append(first, len(terms)))
    docs, new_term = docs[first], new_term[first]
    begins = np.flatnonzero(new_term)
    df = np.diff(np.append(begins, len(docs)))
    before = np.concatenate(([-1], docs[:-1]))
    before[begins] = -1
    data, ends = pack_numbers(np.stack((docs - before, times), axis=1).ravel())
    ends = ends[1::2]

    place = np.arange(len(docs)) - np.repeat(begins, df)
    block = np.flatnonzero(place % BLOCK == 0)
    close = np.append(block[1:], len(docs)) - 1
    body_ends = ends[begins + df - 1]
    body_starts = np.concatenate(([0], body_ends[:-1]))
    blocks = -(-df // BLOCK)
    heads = np.empty((len(block), _HEAD), np.uint32)
    heads[:, 0] = docs[close]
    heads[:, 1] = ends[close] - np.repeat(body_starts, blocks)
    heads[:, 2] = np.maximum.reduceat(times, block)
    heads[:, 3] = np.minimum.reduceat(counts[docs], block)
    yield pa.record_batch(
        [
            pa.array(np.full(len(df), number)),
            pa.array(terms[first][begins].view(np.int64)),
            pa.array(df),
            pa.array(np.add.reduceat(times, begins)),
            _binaries(heads.view(np.uint8).ravel(), np.cumsum(blocks) * _HEAD * 4),
            _binaries(data, body_ends),
        ],
        names=names,
    )


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """All terms of all texts, as rows ``shard term df total heads body``, stored in the shared folder.

    A task makes the shards of the documents that it reads, so postings are never shuffled. The row without a term
    lists a shard's documents and their lengths. A shard ends with the document that reaches ``shard_words``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 24, 0
        ids, counts, terms = [], [], []
        for b in small_batches(batches, "text"):
            hashes, n = scan_terms(*flat_bytes(b.column("text")))
            ids.append(b.column("doc_id"))
            counts.append(n)
            terms.append(hashes)
            held += len(hashes) + b.num_rows
            if held >= shard_words:
                yield from _shard(number, ids, np.concatenate(counts), np.concatenate(terms))
                number, held = number + 1, 0
                ids, counts, terms = [], [], []
        if ids:
            yield from _shard(number, ids, np.concatenate(counts), np.concatenate(terms))

    return staged(rows.mapInArrow(index, INDEX))


class Postings:
    """One term's list in one shard."""

    def __init__(self, weight: int, heads: bytes, body: bytes, norms: np.ndarray, floor_of):
        heads = np.frombuffer(heads, np.uint32).reshape(-1, _HEAD).astype(np.int64)
        self.weight, self.last, self.ends = weight, heads[:, 0], heads[:, 1]
        self.body, self.norms = np.frombuffer(body, np.uint8), norms
        self.block_bounds = weight * ((1_000_000_000 * heads[:, 2]) // (1000 * heads[:, 2] + 20 * floor_of(heads[:, 3])))
        self.bound = int(self.block_bounds.max())
        self.unpacked = 0
        self.held: tuple | None = None

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """What the term adds to documents lo to hi - 1; a block that reaches into the next window is kept for it."""
        none = np.zeros(0, np.int64)
        i, j = np.searchsorted(self.last, (lo, hi - 1))
        j = min(j, len(self.last) - 1)
        if i > j:
            return none, none
        docs, adds = self.held[1:] if self.held and self.held[0] == i else (none, none)
        blocks = np.arange(i + (len(docs) > 0), j + 1)
        if len(blocks):
            more = self.unpack(blocks)
            docs, adds = np.concatenate((docs, more[0])), np.concatenate((adds, more[1]))
        tail = int(np.searchsorted(docs, self.last[j - 1], side="right")) if j else 0
        self.held = (j, docs[tail:], adds[tail:])
        a, b = np.searchsorted(docs, (lo, hi))
        return docs[a:b], adds[a:b]

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in the given ascending blocks, and what the term adds to the score of each."""
        starts = np.where(blocks > 0, self.ends[blocks - 1], 0)
        if blocks[-1] - blocks[0] + 1 == len(blocks):
            data = self.body[starts[0] : self.ends[blocks[-1]]]
        else:
            data = np.concatenate([self.body[i:j] for i, j in zip(starts, self.ends[blocks], strict=True)])
        self.unpacked += len(blocks)
        steps, times = unpack_numbers(data).reshape(-1, 2).T
        run = np.cumsum(steps)
        first = np.arange(len(blocks)) * BLOCK
        base = np.where(blocks > 0, self.last[blocks - 1], -1) - (run[first] - steps[first])
        docs = run + np.repeat(base, np.diff(np.append(first, len(run))))
        return docs, self.weight * ((1_000_000_000 * times) // (1000 * times + 20 * self.norms[docs]))


class Search:
    """One query in one shard, window of documents after window; keeps the ``top`` best so far."""

    def __init__(self, lists: list[Postings], ids: np.ndarray, top: int):
        self.lists = sorted(lists, key=lambda p: p.bound)
        self.reach = np.cumsum([p.bound for p in self.lists])  # most that a document of the first lists alone can get
        self.ids, self.top = ids, top
        self.docs, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def window(self, lo: int, hi: int, ready: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Documents lo to hi - 1. ``ready`` has lists that were unpacked for this window already, whoever asked for them."""
        least = int(self.scores[-1]) if len(self.scores) == self.top else 1
        # Lists that together can't reach the least score needed are not essential: no candidates come from them.
        border = int(np.searchsorted(self.reach, least))
        if border == len(self.lists):
            return
        total = np.zeros(hi - lo, np.int64)
        for p in self.lists[border:]:
            if id(p) not in ready:
                ready[id(p)] = p.between(lo, hi)
            docs, adds = ready[id(p)]
            total[docs - lo] += adds
        found = np.flatnonzero(total > 0)
        scores = total[found]
        found += lo
        for k in range(border - 1, -1, -1):
            p, below = self.lists[k], int(self.reach[k - 1]) if k else 0
            if not len(found):
                return
            # The bound of the block that would hold the candidate rejects it before that block is unpacked.
            block = np.searchsorted(p.last, found)
            within = np.append(p.block_bounds, 0)[block]
            keep = scores + within + below >= least
            found, scores, block = found[keep], scores[keep], block[keep]
            asked = np.unique(block[block < len(p.last)])
            if not len(asked):
                continue
            docs, adds = ready[id(p)] if id(p) in ready else p.unpack(asked)
            if len(docs):
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                scores = scores + np.where(docs[at] == found, adds[at], 0)
        docs, scores = np.concatenate((self.docs, found)), np.concatenate((self.scores, scores))
        best = np.lexsort((docs, self.ids[docs], -scores))[: self.top]
        self.docs, self.scores = docs[best], scores[best]


def _windows(counts: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    ends, lo = np.cumsum(counts + 1), 0
    while lo < len(counts):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + words, side="right")))
        yield lo, hi
        lo = hi


def query_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_block: int = ITEM_BLOCK) -> tuple[DataFrame, int]:
    """``item_block term items`` and the number of blocks: the terms of queries, dealt into blocks of about ``item_block`` queries; a term's queries in a list."""
    rows = items.select(F.col(id_col).alias("item_id"), text_of(text_col).alias("text"))
    blocks = max(1, -(-rows.select("item_id").distinct().count() // item_block))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            hashes, n = scan_terms(*flat_bytes(b.column("text")))
            item = pa.array(np.repeat(np.arange(b.num_rows), n))
            yield pa.record_batch([b.column("item_id").take(item), pa.array(hashes.view(np.int64))], names=["item_id", "term"])

    schema = T.StructType([T.StructField("item_id", rows.schema["item_id"].dataType), T.StructField("term", T.LongType())])
    terms = rows.mapInArrow(scan, schema).distinct()
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("item_block")
    return terms.groupBy(block, "term").agg(F.collect_list(F.struct("item_id")).alias("items")), blocks


def search_index(index: DataFrame, items: DataFrame, top: int = TOP, window_words: int = WINDOW_WORDS, **how) -> DataFrame:
    """``item_id rank doc_id score``: the ``top`` best documents of every item in an index."""
    queries, blocks = query_terms(items, **how)
    counted = index.where("term is null").agg(F.sum("df").alias("n"), F.sum("total").alias("l")).first()
    n_docs, n_words = counted["n"] or 0, counted["l"] or 0
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("all_df") + 1))).cast("long")
    asked = index.join(queries.select("term").distinct(), "term", "left_semi")
    frequency = asked.groupBy("term").agg(F.sum("df").alias("all_df")).select("term", weight.alias("weight")).where("weight > 0")
    wanted = queries.join(frequency, "term").select(F.col("term").alias("asked"), "item_block", "weight", "items")
    lists = index.join(wanted, F.col("term") == F.col("asked")).select("item_block", "shard", "weight", "items", "heads", "body")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("item_block")
    documents = index.where("term is null").select(block, "shard", "heads", "body")
    documents = documents.select("item_block", "shard", F.lit(None).cast("long").alias("weight"), F.lit(None).cast(lists.schema["items"].dataType).alias("items"), "heads", "body")
    item_type = queries.schema["items"].dataType.elementType["item_id"].dataType
    found = T.StructType([T.StructField("item_id", item_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def floor_of(lengths: np.ndarray) -> np.ndarray:
        return 50 + (50 * lengths.astype(np.int64) * n_docs) // max(1, n_words)

    def search(table: pa.Table) -> pa.Table:
        weights, heads, bodies = (table[c].to_pylist() for c in ("weight", "heads", "body"))
        row = weights.index(None)
        size = len(heads[row])
        missing = np.frombuffer(heads[row], np.uint8).astype(bool)
        doc_ids = np.frombuffer(bodies[row], np.int64, size)
        counts = np.frombuffer(bodies[row], np.int32, size, 8 * size)
        norms = floor_of(counts)
        by_item: dict = {}
        for weight, head, body, items in zip(weights, heads, bodies, table["items"].to_pylist(), strict=True):
            if weight is not None:
                postings = Postings(weight, head, body, norms, floor_of)
                for item in items:
                    by_item.setdefault(item["item_id"], []).append(postings)
        order = np.where(missing, np.iinfo(np.int64).max, doc_ids)  # documents without an id come last among equals
        searches = {item: Search(found_lists, order, top) for item, found_lists in by_item.items()}
        for lo, hi in _windows(counts, window_words):
            ready: dict = {}
            for s in searches.values():
                s.window(lo, hi, ready)
        docs = np.concatenate([s.docs for s in searches.values()] or [np.zeros(0, np.int64)]).astype(np.int64)
        scores = np.concatenate([s.scores for s in searches.values()] or [np.zeros(0, np.int64)])
        names = [item for item, s in searches.items() for _ in range(len(s.docs))]
        return pa.table(
            [
                pa.array(names, table.schema.field("items").type.value_type.field("item_id").type),
                pa.array(doc_ids[docs], mask=missing[docs]),
                pa.array(scores),
            ],
            names=["item_id", "doc_id", "score"],
        )

    heaps = lists.unionByName(documents).groupBy("item_block", "shard").applyInArrow(search, found)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The ``top`` best documents for every item: ``item_id rank doc_id score``.

    Terms are runs of 0-9, a-z (A-Z lower-cased) and characters beyond ASCII. The score sums, over an item's terms, the
    term's weight floor(1000 ln((2N + 2) / (2 df + 1))) times 10^9 tf div (1000 tf + 20 m), m = 50 + 50 n N div L, with N documents that have
    terms, L terms in all, n in the document. Every term of every text is indexed; each shard is searched by Block-Max MaxScore, which
    only skips what can't be among the best, and the shards' best are merged, so the result is exact.

    Null texts have no terms; documents and items without terms are in no result, nor are documents of score 0. Equal scores go by
    ascending id, a missing id last; repeated rows are documents of their own. Rows of one item id, null too,
    are one item. Other columns are ignored; with an empty table on either side there are no rows.
    """
    return search_index(build_index(docs, id_col, text_col), items, top, **how)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, read(spark, sf_dir, "benchmark").select("item_id", "text"))


OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), c AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d),
t AS (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY ALL),
v AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
s AS (
  SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words))))::BIGINT AS score
  FROM i JOIN tf USING (term) JOIN v USING (term), c GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {TOP}
"""
