"""Each operator on odd rows, on nothing, and against plain versions."""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import bagminhash, chat, decontaminate, line_dedup, mixing, paragraph_dedup, pii, quality_crf, quality_rules, suffix_dedup
from rivulet.llm.common import read, staged
from rivulet.llm.components import components
from rivulet.llm.suffix_array import permuted_prefixes, suffix_array
from rivulet.llm.textscan import scan_words
from tests.llm import brute
from tests.llm.conftest import CLASHES, prose

SMALL = "/root/testdata/sf0.001"


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def plain_pieces(text):
    """The pieces that ``paragraph_dedup`` cuts one text into."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    lo, hi, _ = paragraph_dedup.pieces(scan_words(raw, np.array([0, len(raw)])))
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


# 1, line dedup


def test_line_dedup_matches_plain_version(odd_docs, unique_rows):
    out = line_dedup.dedup_lines(odd_docs)
    assert set(CLASHES) <= set(out.columns)
    rows = out.select("doc_id", "n_lines", "n_deleted", "text").collect()
    assert len(rows) == odd_docs.count()
    want = brute.line_dedup(unique_rows)
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["n_lines"], r["n_deleted"], r["text"] or "") == want[r["doc_id"]], r["doc_id"]
    null = [r for r in rows if r["doc_id"] == 4]
    assert null[0]["text"] is None
    assert [r["n_deleted"] for r in rows if r["doc_id"] is None] == [0, 0]
    assert [r["text"] for r in rows if r["doc_id"] == 9] == ["Same line again and again here."]


def test_line_dedup_stays_in_the_jvm_and_takes_nothing(odd_docs, no_docs):
    plan = line_dedup.dedup_lines(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert line_dedup.dedup_lines(no_docs).count() == 0


# 2, quality classifier


def test_forward_backward_matches_sum_over_paths():
    rng = np.random.default_rng(0)
    text = np.array([0, 0, 0, 1, 2, 2])
    emission, step = rng.normal(size=6), rng.normal(size=(2, 2))
    good, pairs, total = quality_crf.forward_backward(emission, step, text, 3)
    want, sums, counted = np.zeros(6), 0.0, np.zeros((2, 2))
    for t in range(3):
        lines = np.flatnonzero(text == t)
        weights = {}
        for code in range(2 ** len(lines)):
            y = [code >> k & 1 for k in range(len(lines))]
            weights[tuple(y)] = math.exp(sum(emission[i] * v for i, v in zip(lines, y, strict=True)) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
        z = sum(weights.values())
        sums += math.log(z)
        for y, v in weights.items():
            want[lines] += np.array(y) * v / z
            for a, b in zip(y, y[1:], strict=False):
                counted[a, b] += v / z
    assert np.allclose(good, want) and np.allclose(pairs, counted) and math.isclose(total, sums)


def test_groups_of_texts_change_no_sum(monkeypatch):
    rng = np.random.default_rng(1)
    lines = rng.integers(1, 40, 60)
    text = np.repeat(np.arange(60), lines)
    emission, step = rng.normal(size=len(text)), rng.normal(size=(2, 2))
    whole = quality_crf.forward_backward(emission, step, text, 60)
    monkeypatch.setattr(quality_crf, "CELLS", 50)
    parts = quality_crf.forward_backward(emission, step, text, 60)
    assert np.allclose(whole[0], parts[0]) and np.allclose(whole[1], parts[1]) and math.isclose(whole[2], parts[2])


def test_a_text_of_very_many_lines_needs_little_memory():
    import tracemalloc

    import pyarrow as pa

    from rivulet.llm.common import flat_bytes

    model = quality_crf.Model(np.zeros(3 * quality_crf.OWN), np.ones(3 * quality_crf.OWN), np.zeros(3 * quality_crf.OWN + 1), np.zeros((2, 2)))
    texts = pa.array(["a\nb\n" * 50_000, *[prose(i, 30) for i in range(2000)]])
    tracemalloc.start()
    scores = model.scores(*flat_bytes(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(scores) == 2001 and np.allclose(scores, 0.5) and peak < 500e6


def test_classifier_learns_and_scores_all(spark, odd_docs, no_docs):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    model = quality_crf.train(docs, labels)
    scored = quality_crf.score(docs, model).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    odd = quality_crf.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality_crf.score(no_docs, model).count() == 0
    assert quality_crf.train(docs, labels.where("false")) is None
    assert {r["score"] for r in quality_crf.score(odd_docs, None).collect()} == {0.5}


# 3, personal data


def test_base_spans_match_plain_patterns(spark, odd_docs, odd_rows):
    tricky = ["a@b.c_d@e.f", "x@y@z.io", "1.2.3.4.5.6.7.8", "300.1.1.1 1.1.1.1", "+1 2 3 4 5 6 7 8 9", "++4930 123456-", "4111-1111-1111-1111 5", "9" * 20000, "a" * 20000 + "@", "0000255.1.1.01"]
    rows = [(100 + i, t) for i, t in enumerate(tricky)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = pii.find_personal_data(docs).select("doc_id", "hash", pii._told(F.col("base")).alias("told")).collect()
    want = {i: brute.personal(t)[1] for i, t in [*odd_rows, *rows] if i is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert r["told"] == want[r["doc_id"]], r["doc_id"]
    assert len(got) == docs.count()


def test_disclosing_terms_are_found_and_sanitised(spark, no_docs):
    rows = [(i, f"{prose(50 + i, 30)} Quibbly lives at z.x{'y' * i}@mail.example.org and knows {prose(90 + i, 5)}") for i in range(2)]
    rows += [(10 + i, f"{prose(150 + i, 40)} the agent Zorblax uses spy@secret.example.org daily {prose(190 + i, 20)}") for i in range(4)]
    rows += [(20 + i, prose(250 + i, 60) + " the daily news") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    terms = {s["found"].lower() for s in found[10]["extra"]}
    assert "zorblax" in terms and "agent" in terms and "the" not in terms and "daily" not in terms
    assert not found[0]["extra"] and not found[25]["base"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "spy@" not in clean[10] and "Zorblax" not in clean[10] and "[EMAIL]" in clean[10] and "[TERM]" in clean[10]
    assert clean[25] == dict(rows)[25]
    assert pii.find_personal_data(no_docs).count() == 0 and pii.sanitise(no_docs).count() == 0


def test_copies_of_a_text_do_not_hide_a_term(spark):
    rows = [(i, f"{prose(500 + i, 40)} agent Zorblax uses spy@secret.example.org now") for i in range(3)]
    rows += [(100 + i, rows[0][1]) for i in range(200)] + [(1000 + i, prose(600 + i, 20)) for i in range(97)]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (0, 2, 150):
        assert "zorblax" in {s["found"].lower() for s in found[i]["extra"]}


def corpus_with_class(n):
    """No address stands in two texts; a domain stands in four, other domains in two and one, one word in thirty."""
    rows = [(i, f"{prose(700 + i, 40)} agent Zorblax uses spy{i}@secret.example.org now and {prose(720 + i, 20)}") for i in range(4)]
    rows += [(10 + i, f"{prose(740 + i, 40)} Quuxley asks jo@other{i // 2}.example.org there {prose(760 + i, 20)}") for i in range(2)]
    rows += [(20, f"{prose(780, 40)} Onceler at once@third.example.org {prose(781, 20)}")]
    rows += [(30 + i, f"{prose(900 + i, 10)} m{i}@wide.example.org " + prose(950 + i, 90) + " Kr of ours") for i in range(30)]
    return rows + [(100 + i, f"unique{i}a " + prose(800 + i % 300, 30) + f" now and there b{i}") for i in range(n)]


@pytest.mark.parametrize("n", [1000, 20_000])
def test_terms_of_classes_whatever_the_size_of_the_corpus(spark, n):
    rows = corpus_with_class(n)
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    terms = {i: {s["found"].lower() for s in found[i]["extra"]} for i in found}
    assert all("zorblax" in terms[i] and not found[i]["strong_terms"] and "now" not in terms[i] for i in range(4))
    assert not terms[10] and not terms[11] and not terms[20]  # one or two texts prove nothing
    # Words far from the entity and of two letters are judged as well; thirty texts prove nearly all.
    assert all("kr" in terms[30 + i] and "kr" in found[30 + i]["strong_terms"] for i in range(30))
    assert not any(terms[i] for i in terms if i >= 100)


def test_unique_words_beside_single_entities_are_no_terms(spark):
    rows = [(i, f"lone{i}x at a{i}@host{i}.example.org lone{i}y") for i in range(200)]
    rows += [(1000 + i, f"w{i} v{i} u{i}") for i in range(61_000)]
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("size(extra) > 0").count() == 0 and out.where("size(base) > 0").count() == 200


def test_terms_match_plain_version(spark, odd_docs, odd_rows):
    for rows in (corpus_with_class(150), [(i, t) for i, t in odd_rows] + [(500 + i, f"jo.doe@mail.example.org {prose(i, 6)} Vexa{i % 4}") for i in range(24)]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {}
        for r in pii.find_personal_data(df).collect():
            got.setdefault(r["text"] if "text" in r else r["hash"], set()).update(s["found"].lower() for s in r["extra"])
        want = brute.disclosing([t for _, t in rows])
        hashes = {r["h"]: r["t"] for r in df.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.coalesce("text", F.lit("")).alias("t")).collect()}
        assert {hashes[h]: terms for h, terms in got.items()} == want
        assert any(want.values()) == (rows[0][0] == 0)


# 4, mixing


def test_mix_keeps_quotas_and_order(spark, odd_docs, no_docs):
    rows = [(i, prose(i, 40), "big") for i in range(200)] + [(1000 + i, prose(1000 + i, 40), "small") for i in range(30)]
    rows += [(2000 + i, prose(2000 + i, 40), None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_sources(docs, max_repeats=3.0, block_tokens=400).collect()
    times: dict = {}
    for r in out:
        times.setdefault(r["source"], {}).setdefault(r["doc_id"], []).append(r["mix_epoch"])
    assert set(times["big"].values().__iter__().__next__()) == {0} and len(times["big"]) == 200
    for source, n in (("small", 30), (None, 20)):
        assert len(times[source]) == n
        assert all(sorted(e) == list(range(len(e))) for e in times[source].values())
        assert {len(e) for e in times[source].values()} <= {1, 2, 3}
    assert sum(map(len, times[None].values())) / 20 <= 3
    odd = mixing.mix_sources(odd_docs).collect()
    assert len(odd) >= odd_docs.count() and set(CLASHES) <= set(odd[0].asDict())
    assert mixing.mix_sources(no_docs).count() == 0
    fixed = mixing.plan_mix(docs, budget_tokens=4000, block_tokens=400).agg(F.sum("mix_tokens").alias("n")).first()["n"]
    assert 3600 <= fixed <= 4000


def test_exponent_meets_entropy_or_limit(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10)], "source string, total long")
    tau = mixing.exponent(totals, 0.9, 1e9).first()["tau"]
    w = np.array([1000, 100, 10.0]) ** tau
    w /= w.sum()
    assert math.isclose(-(w * np.log(w)).sum(), 0.9 * math.log(3), rel_tol=1e-9)
    tau = mixing.exponent(totals, 1.0, 4.0).first()["tau"]
    assert math.isclose(100 ** (1 - tau), 4.0, rel_tol=1e-9)


# 5, decontamination


def test_contamination_matches_plain_version(spark, odd_docs, odd_rows, no_docs):
    a, long = odd_rows[0][1], odd_rows[10][1]
    items = [(1, " ".join(a.split()[20:60])), (20, "one two"), (3, None), (4, "nothing like it " * 6), (5, " ".join(long.upper().split()[5000:5020])), (6, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_windows in (decontaminate.BLOCK_WINDOWS, 10):
        out = decontaminate.find_contamination(odd_docs, bench, block_windows=block_windows).collect()
        assert len(out) == odd_docs.count()
        want = brute.contamination([x for x in odd_rows if x[0] is not None], items)
        for r in out:
            if r["doc_id"] is not None:
                assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == want[r["doc_id"]], r["doc_id"]
    kept = decontaminate.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if not r["contaminated"]}
    assert decontaminate.find_contamination(no_docs, bench).count() == 0
    assert not any(r["n_hit"] for r in decontaminate.find_contamination(odd_docs, bench.where("false")).collect())


def test_proximity(spark):
    item = prose(70, 13)
    words = item.split()
    moved = " ".join([*words[:5], "extra", *words[5:]])
    docs = spark.createDataFrame([(1, moved), (2, "x " * 20 + words[3]), (3, item)], "doc_id long, text string")
    got = by_id(decontaminate.find_contamination(docs, spark.createDataFrame([(9, item)], "item_id long, text string")), "items", "near_items")
    assert got == {1: ([], ["9"]), 2: ([], []), 3: (["9"], ["9"])}


def test_proximity_matches_plain_version(spark, monkeypatch):
    """Items with words put in, left out and swapped, looked for in many blocks of windows over one index."""
    r = np.random.default_rng(6)
    items = [(i, prose(700 + i, (13, 30, 7, 60)[i % 4])) for i in range(8)]
    docs = [(100, None), (101, "")]
    for i in range(60):
        w = items[i % 8][1].split()
        for k in sorted(r.integers(0, len(w), i // 12), reverse=True):
            w[k : k + 1] = ([w[k], "more"], [], w[k : k + 1] * 2, ["other"])[k % 4]
        a, z = sorted(r.integers(0, len(w), 2)) if i % 5 == 4 else (0, 0)
        w[a], w[z] = w[z], w[a]
        docs.append((i, " ".join([*prose(i, i % 9).split(), *w, *prose(i + 50, i % 7).split()])))
    built, build = [], decontaminate.build_index
    monkeypatch.setattr(decontaminate, "build_index", lambda *how: built.append(1) or build(*how))
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    exact, near = brute.contamination(docs, items), brute.proximity(docs, items)
    for block_windows in (25, 1000):
        got = by_id(decontaminate.find_contamination(*tables, block_windows=block_windows), "n_words", "n_hit", "items", "contaminated", "near_items")
        assert {i: x[:4] for i, x in got.items()} == exact and {i: x[4] for i, x in got.items()} == near
    assert len(built) == 2 and sum(map(len, near.values())) > sum(len(x[2]) for x in exact.values())


def test_index_holds_frequent_words_and_far_places(spark):
    """A word that occurs 70,000 times, and matches beyond place 65,536."""
    item = prose(71, 20)
    docs = [(1, "again " * 70_000 + item + " again" * 300), (2, item), (3, "again " * 20)]
    items = [(1, item), (2, "again " * 14 + item.split()[0])]
    got = by_id(
        decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")),
        "n_words", "n_hit", "items", "contaminated",
    )
    assert got == brute.contamination(docs, items)


# 6, chat formatting


def test_chats_are_read_back_exactly(spark):
    odd = ["", None, "\\", "</turn>\n### User: hi", "<+turn>", "####", "a\\</turn>", "</tur", "n>\n", "#\\#", "é漢\n\n", "\\n </turn>\n"]
    rows = [(c, t, role, odd[(c + t) % len(odd)]) for c in range(12) for t, role in enumerate(["system", "user", "user", "assistant", "assistant", "Tool:=x", None, "assistant"])]
    rows += [(None, 1, "user", "x"), (50, 1, "b", "tie"), (50, 1, "a", "tie"), (50, 1, "a", "tie"), (51, None, "assistant", "only")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("x"))
    back = {r["conv_id"]: r for r in chat.parse_chats(chat.format_chats(turns)).collect()}
    want: dict = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or -1, r[1] or -1, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [(x["role"], x["text"]) for x in r["turns"]] for c, r in back.items()} == want
    for c, r in back.items():
        assert r["loss_text"] == "".join(t for role, t in want[c] if role == "assistant")
    assert back[50]["formatted"].count("### ") == 2
    assert chat.format_chats(turns.where("false")).count() == 0


# 7, quality rules


def test_quality_counts_match_plain_version(spark, odd_docs, odd_rows):
    names = quality_rules.COUNTS[:5]
    out = odd_docs.select("doc_id", quality_rules.counts_of(F.coalesce("text", F.lit(""))).alias("c")).collect()
    want = {i: brute.quality_counts(t) for i, t in odd_rows if i is not None}
    for r in out:
        if r["doc_id"] is not None:
            assert tuple(r["c"][c] for c in names) == want[r["doc_id"]], r["doc_id"]


def test_binomial_bound():
    direct = sum(math.comb(50, i) * 0.1**i * 0.9 ** (50 - i) for i in range(3))
    assert math.isclose(quality_rules.binomial_at_most(2, 50, 0.1), direct, rel_tol=1e-9)


def thue_morse(n, letters):
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    return a.translate(str.maketrans("ab", letters))


def test_strings_that_polynomial_hashes_confuse_are_counted_apart(spark):
    a, b = thue_morse(12, "xy"), thue_morse(12, "yx")
    rows = [(1, f"{a}\n{b}\n{a[:300]}\n{a[:300]}"), (2, f"{a} {a} {a} q {b} {b} {b}")]
    out = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", quality_rules.counts_of(F.col("text")).alias("c")).collect()
    for r in out:
        assert tuple(r["c"][c] for c in quality_rules.COUNTS[:5]) == brute.quality_counts(dict(rows)[r["doc_id"]])


def test_three_hundred_good_labels_prove_cutoffs(spark):
    """Several languages with few labels each; one with good documents that look like junk keeps loose cutoffs."""
    rows = [(k * 1000 + i, prose(k * 1000 + i, 80), lang) for k, lang in enumerate(["en", "de", None]) for i in range(300)]
    rows += [(5000 + i, " | ".join(prose(i, 80).split()), ["en", "de", None][i % 3]) for i in range(60)]
    rows += [(9000 + i, " | ".join(prose(i, 80).split()) if i % 3 == 0 else prose(i, 80), "odd") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.where("doc_id < 3000 or doc_id >= 9000").select("doc_id", F.lit(1).alias("quality"))
    out = by_id(quality_rules.apply_rules(docs, labels), "kept", "failed_rules")
    assert all("symbols" in out[5000 + i][1] for i in range(60))
    assert sum(not out[9000 + i][0] for i in range(300)) <= 0.05 * 300
    for k in range(3):
        assert sum(not out[k * 1000 + i][0] for i in range(300)) <= 0.05 * 300


def test_verdicts_count_every_text_once(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    out = quality_rules.apply_rules(odd_docs, labels).where("kept")
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()  # the counts were stored


def test_cutoffs_spare_good_documents(spark, odd_docs, no_docs):
    good = [(i, prose(i, 80), "en") for i in range(400)]
    bad = [(1000 + i, " | ".join(prose(i, 80).split()), "en") for i in range(50)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(400)] + [(1000 + i, 0) for i in range(50)], "doc_id long, quality int")
    out = by_id(quality_rules.apply_rules(docs, labels, false_rejection=0.2), "kept", "failed_rules")
    assert sum(not out[i][0] for i in range(400)) <= 0.2 * 400
    assert all("symbols" in out[1000 + i][1] for i in range(50))
    few = by_id(quality_rules.apply_rules(docs, labels.where("doc_id < 10")), "kept", "base_failed")
    assert all(kept != failed for kept, failed in few.values())  # too few labels prove nothing
    odd = quality_rules.apply_rules(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and not [r for r in odd if r["doc_id"] in (4, 5) and r["kept"]]
    assert quality_rules.apply_rules(no_docs, labels).count() == 0
    assert quality_rules.apply_rules(odd_docs, labels.where("false")).count() == odd_docs.count()


# 8, paragraphs


def test_paragraphs_and_passages(spark, odd_docs, odd_rows, no_docs):
    out = paragraph_dedup.dedup_paragraphs(odd_docs).collect()
    assert len(out) == odd_docs.count()
    kept = {r["doc_id"]: r for r in out}
    texts = dict(odd_rows)
    for i in (1, 5, 6, 8, 11, 12, 15):
        assert kept[i]["kept"] == texts[i], i
    assert kept[4]["kept"] == ""
    assert len(brute.words(kept[2]["kept"])) < 60 and len(brute.words(kept[3]["kept"])) < 90
    assert brute.words(prose(3, 70))[12:-12] == brute.words(kept[6]["kept"])[73:-73]
    assert brute.words(kept[7]["kept"]) == brute.words(prose(6, 60) + " end next " + prose(7, 60))
    assert len(kept[16]["kept"]) < 1000
    assert paragraph_dedup.dedup_paragraphs(no_docs).count() == 0


def test_similar_paragraphs_match_plain_version(spark):
    base = [prose(300 + i, 90).replace("\n", " ") for i in range(6)]
    rows, r = [], np.random.default_rng(5)
    for i in range(40):
        w = base[i % 6].split()
        for k in r.integers(0, len(w), i // 8):
            w[k] = f"new{i}x{k}"
        rows.append((i, " ".join(w)))
    want = brute.near_classes(rows, multiset=False)
    out = by_id(paragraph_dedup.dedup_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")), "kept")
    assert all((out[i][0] == "") for i, c in want.items() if c != i)
    assert paragraph_dedup.tune_bands(0.8, 3, 0.999) == 10


def test_pasted_passages_go_whole(spark):
    """Passages of 51 to 80 words inside longer lines, some of them around one that a third text has too."""
    r = np.random.default_rng(8)

    def some(n):
        return [f"w{x}" for x in r.integers(0, 1 << 40, n)]

    rows, want = [], {}
    for i in range(200):
        passage = some((51, 60, 80)[i % 3])
        own = some(60 + i % 7), some(60 + i % 11)
        if i % 4 == 0:  # an earlier text has the middle only: the ends are the next one's
            rows.append((3 * i, " ".join(some(40) + passage[15:40] + some(40))))
        rows.append((3 * i + 1, " ".join(some(i % 50) + passage + some(i % 30))))
        rows.append((3 * i + 2, " ".join(own[0] + passage + own[1])))
        want[3 * i + 2] = " ".join(own[0] + own[1])
    out = by_id(paragraph_dedup.dedup_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")), "kept")
    assert sum(out[i][0] == w for i, w in want.items()) >= 199


def test_overlapping_passages_lie_between_plain_versions(spark, unique_rows):
    """At least the repeated runs around pieces go, at most the repeated runs around any four words."""
    common = prose(70, 400).split()
    r = np.random.default_rng(9)
    rows = [*unique_rows]
    for i in range(100, 140):  # texts spliced of runs of a common one, so that passages overlap and repeat inside texts
        cut = [common[a : a + n] for a, n in zip(r.integers(0, 380, 8), r.integers(3, 60, 8), strict=True)]
        rows.append((i, "\n".join(" ".join(c) for c in cut) if i % 2 else " ".join(" ".join(c) for c in cut)))
    rows += [(200, "again and " * 90), (201, "x " + "again and " * 70 + "y"), (202, "a b c"), (203, "a b c")]
    out = by_id(paragraph_dedup.dedup_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")), "n_paragraphs", "n_removed", "removed_bytes", "kept")
    least = brute.substring_dedup(rows, plain_pieces)
    most = brute.substring_dedup(rows, lambda t: [(k, k + 4) for k in range(len(brute.words(t)) - 3)])

    def inside(few, many):
        rest = iter(many)
        return all(x in rest for x in few)

    for i, _ in rows:
        kept = brute.words(out[i][3])
        assert inside(kept, brute.words(least[i][3])) and inside(brute.words(most[i][3]), kept), i
    assert sum(out[i] != least[i] for i, _ in rows) <= 3


# 9, near-duplicates


def test_near_duplicates_match_plain_version(spark, odd_docs, unique_rows, no_docs):
    out = bagminhash.near_duplicates(odd_docs).collect()
    assert len(out) == odd_docs.count()
    want = brute.near_classes(unique_rows)
    for r in out:
        if r["doc_id"] is not None:
            assert r["class_id"] == want[r["doc_id"]], r["doc_id"]
    assert len({r["class_id"] for r in out if r["doc_id"] is None}) == 1
    kept = bagminhash.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted([*{want[i] for i in want}, -1])
    assert bagminhash.near_duplicates(no_docs).count() == 0


def test_large_families_are_compared_in_blocks(spark, monkeypatch):
    from rivulet.llm import families

    base = prose(400, 200).split()
    r = np.random.default_rng(3)
    rows = []
    for i in range(60):
        w = list(base)
        for k in r.integers(0, len(w), r.integers(0, 7)):
            w[k] = f"new{i}x{k}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(families, "BLOCK_DOCS", 7)
    got = by_id(bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "class_id")
    assert {i: c[0] for i, c in got.items()} == brute.near_classes(rows)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    a, b = {k: int(rng.integers(1, 5)) for k in range(60)}, {k: int(rng.integers(1, 5)) for k in range(20, 90)}
    true = sum(min(a[k], b[k]) for k in a if k in b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    got = []
    for salt in range(30):
        keys = bagminhash.mix(np.array([*a, *b], np.uint64) + np.uint64(salt * 1000))
        s = bagminhash.signatures(2, np.array([0] * len(a) + [1] * len(b)), keys, np.array([*a.values(), *b.values()]))
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - true) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 120)] + [(7, 7), (200, 150)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{k: 100 for k in range(100, 120)}, 200: 150, 150: 150}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

def test_signatures_keep_large_counts():
    for a, b in ((95, 96), (510, 640), (5000, 5200), (1 << 20, 1300000)):
        same = []
        for salt in range(20):
            keys = bagminhash.mix(np.array([7, 7], np.uint64) + np.uint64(salt * 1000))
            s = bagminhash.signatures(2, np.array([0, 1]), keys, np.array([a, b]))
            same.append((s[0] == s[1]).mean())
        assert abs(np.mean(same) - a / b) < 0.03, (a, b)



# 10, suffix arrays


@pytest.mark.parametrize("letters", [1, 2, 4, 60])
def test_suffix_array(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 2, 7, 300):
        data = (rng.integers(0, letters, n) + 97).astype(np.uint8)
        text, order = data.tobytes(), suffix_array(data, 50)
        assert sorted(order) == list(range(n))
        assert [text[i : i + 50] for i in order] == sorted(text[i : i + 50] for i in range(n))
        shared = permuted_prefixes(data, order.astype(np.int64), 50)
        for a, b in zip(order, order[1:], strict=False):
            same = next((k for k in range(50) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or a + k >= n), 50)
            assert shared[b] == same


def test_substrings_match_plain_version(spark, odd_docs, unique_rows, no_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    out = suffix_dedup.remove_repeats(odd_docs).collect()
    assert len(out) == odd_docs.count()
    want = brute.cut_substrings(unique_rows)
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) == want[r["doc_id"]], r["doc_id"]
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


# Staging


def test_staged_rows_are_the_same(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text")
    assert sorted(map(repr, staged(rows).collect())) == sorted(map(repr, rows.collect()))
    assert json.loads(staged(rows).schema.json()) == json.loads(rows.schema.json())


def test_repeated_runs_go_to_their_last_line(spark):
    """Runs of one line and of many short ones, from their first line to the last; short copies of a few words stay."""
    long_line = "alpha bravo charlie delta echo foxtrot golf hotel india"
    short = [f"s{k} x" for k in range(6)]
    rows = [
        (1, "\n".join(["first here", *short, "own one", long_line, "own two"])),
        (2, "\n".join(["else", *short, "other", long_line])),
        (3, "\n".join(["s0 x", "s1 x", "s2 x", "end of it"])),  # six words in a row only
        (4, "\n".join(["go on"] * 30)),
        (5, "汉" * 90 + "\n" + "b c"),
        (6, "汉" * 90),
    ]
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.line_dedup(rows)
    assert {i: (r["n_lines"], r["n_deleted"], r["text"]) for i, r in out.items()} == want
    assert out[2]["text"] == "else\nother" and out[3]["n_deleted"] == 0 and out[4]["text"] == "go on" and out[6]["text"] == ""


def test_long_texts_of_lines_cost_in_proportion(spark):
    import time

    def took(n):
        text = "\n".join(f"line number {k} of a text with quite a few words" for k in range(n))
        df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        start = time.perf_counter()
        assert line_dedup.dedup_lines(df).where("doc_id = 2").first()["n_deleted"] == n
        return time.perf_counter() - start

    took(500)
    assert took(32_000) < 8 * max(1.0, took(8_000))
