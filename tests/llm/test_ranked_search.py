from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from rivulet.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    """Every document scored for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_words = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    wanted: dict = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, asked in wanted.items():
        scored = []
        for (doc, bag), size in zip(bags, sizes, strict=True):
            if size:
                m = 100 - 50 + (50 * size * n_docs) // n_words
                parts = (math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in asked if bag[t])
                scored.append((sum(parts), doc))
        best = sorted((s for s in scored if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:top]
        out += [(repr(item), k, repr(doc), score) for k, (score, doc) in enumerate(best, 1)]
    return sorted(out)


def told(df):
    return sorted((repr(r["item_id"]), r["rank"], repr(r["doc_id"]), r["score"]) for r in df.collect())


ITEMS = [(1, "été changed word"), (2, "Same LINE again"), (3, None), (None, "one two"), (4, ""), (5, "unseen"), (6, "mail example 漢字"), (6, "one two"), (7, "...")]


def test_odd_rows_match_plain_version(spark, odd_docs, odd_rows):
    long_item = (8, odd_rows[10][1][:3000])
    items = spark.createDataFrame([*ITEMS, long_item], "item_id long, text string").selectExpr("*", "'x' as doc_id", "1 as term")
    for top, size, window in ((50, 4_000_000, 500_000), (3, 300, 100), (1, 1, 1)):
        index = rs.build_index(odd_docs, shard_words=size)
        assert told(rs.search_index(index, items, top, window_words=window, item_block=2)) == brute(odd_rows, [*ITEMS, long_item], top)


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rs.search(no_docs, items).count() == 0 and rs.search(odd_docs, items.where("false")).count() == 0
    assert rs.search(odd_docs.where("doc_id = 4"), items).count() == 0  # no document has terms


def test_ties_go_by_id_and_copies_are_documents(spark):
    docs = [(i, "tie word " + "x " * 5) for i in range(400, 0, -1)] + [(None, "tie word " + "x " * 5), (7, "tie word " + "x " * 5)]
    docs += [(i, "other text") for i in range(500, 900)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, "tie")], "item_id long, text string")
    got = told(rs.search_index(rs.build_index(frame, shard_words=700), items, 50, window_words=90))
    assert got == brute(docs, [(1, "tie")], 50)


@pytest.fixture(scope="module")
def zipf():
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    weights = [1 / (k + 1) for k in range(3000)]
    return [" ".join(r.choices(vocabulary, weights, k=r.randint(5, 80))) for _ in range(4000)]


def test_block_bounds_spare_unpacking_and_lose_nothing(zipf):
    """One shard searched directly: rare terms decide, blocks of frequent ones stay packed."""
    import pyarrow as pa

    hashes, counts = rs.scan_terms(*rs.flat_bytes(pa.array(zipf)))
    _, rows = rs._shard(0, [pa.array(range(len(zipf)), pa.int64())], counts, hashes)
    lists = dict(zip(rows["term"].to_pylist(), zip(rows["df"].to_pylist(), rows["heads"].to_pylist(), rows["body"].to_pylist(), strict=True), strict=True))
    n_docs, n_words = len(zipf), len(hashes)

    def floor_of(n):
        return 50 + (50 * n.astype(np.int64) * n_docs) // n_words

    query = "w0 w1 w2 w900 w1500"
    asked, _ = rs.scan_terms(*rs.flat_bytes(pa.array([query])))
    postings = []
    for t in asked.view(np.int64).tolist():
        df, head, body = lists[t]
        postings.append(rs.Postings(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))), head, body, floor_of(counts), floor_of))
    s = rs.Search(postings, np.arange(n_docs), 5)
    for lo, hi in rs._windows(counts, 12_000):
        s.window(lo, hi, {})
    want = [(int(d), sc) for _, _, d, sc in sorted(brute(list(enumerate(zipf)), [(1, query)], 5), key=lambda x: x[1])]
    assert list(zip(s.docs.tolist(), s.scores.tolist(), strict=True)) == want
    everything = sum(len(p.last) for p in postings)
    assert sum(p.unpacked for p in postings) < 0.7 * everything


def test_numbers_pack_and_unpack():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 268435455, 268435456, 2**34, 5])
    data, ends = rs.pack_numbers(values)
    assert rs.unpack_numbers(data).tolist() == values.tolist() and ends[-1] == len(data)


def test_terms_of_one_length_that_polynomial_hashes_confuse_stay_apart():
    import pyarrow as pa

    a = "a"
    for _ in range(12):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    hashes, counts = rs.scan_terms(*rs.flat_bytes(pa.array([a, b, a.upper(), "", "x" * 63, "x" * 64, "x" * 65])))
    assert counts.tolist() == [1, 1, 1, 0, 1, 1, 1] and len(set(hashes.tolist())) == 5 and hashes[0] == hashes[2] != hashes[1]
