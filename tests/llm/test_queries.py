"""The registered corpus queries on the smallest tables: against their SQL, or against plain versions."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from rivulet.llm.queries import ORACLES, QUERIES
from tests.llm import brute
from tests.llm.test_operators import plain_pieces
from tests.test_catalog import normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_all_are_registered():
    names = driver.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names and set(ORACLES) <= set(driver.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal([tuple(r) for r in df.collect()], df.columns) == normal(result.fetchall(), columns)


def test_classes_match_plain_version(spark, documents):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op9_minhash_near_dedup"](spark, SF).collect()}
    assert got == brute.near_classes(documents)


def test_substring_dedup_matches_plain_version(spark, documents):
    got = {r["doc_id"]: (r["n_paragraphs"], r["n_removed"], r["removed_bytes"], r["text"]) for r in QUERIES["op8_substring_dedup"](spark, SF).collect()}
    assert got == brute.substring_dedup(documents, plain_pieces)


def test_personal_data_matches_plain_version(spark, documents):
    import hashlib

    want = {i: brute.personal(t) for i, t in documents}
    for r in QUERIES["op3_pii"](spark, SF).collect():
        counts, told = want[r["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))


def test_quality_rules_match_plain_version(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality_rules"](spark, SF).collect()}
    for i, text in documents:
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.quality_counts(text)
        assert r["base_failed"] == brute.base_failed(text)
        assert r["kept"] == (not r["base_failed"])  # so few labels prove no cutoff here


def test_quality_rules_choose_cutoffs_on_a_larger_table(spark):
    """With 40 times the labels the query rejects junk that passes the base rule, and few of the good documents."""
    rows = QUERIES["op7_quality_rules"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id"
    ).join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id").where("not base_failed").collect()
    for lang in {r["lang"] for r in rows}:
        good = [r["kept"] for r in rows if r["lang"] == lang and r["quality"] == 1]
        bad = [r["kept"] for r in rows if r["lang"] == lang and r["quality"] == 0]
        assert good.count(False) <= 0.05 * len(good) and (len(bad) < 10 or bad.count(False) >= 0.9 * len(bad)), (lang, len(good), len(bad))


def test_terms_match_plain_version(spark, documents):
    want = brute.disclosing([t for _, t in documents])
    told = dict(documents)
    for r in QUERIES["op3_pii"](spark, SF).collect():
        assert (r["n_terms"] > 0) == bool(want[told[r["doc_id"]] or ""])


def test_pipeline_matches_plain_stages(spark, database, documents):
    kept = [(i, t) for i, t in documents if not brute.base_failed(t)]
    lines = brute.line_dedup(kept)
    kept = [(i, lines[i][2]) for i, _ in kept if lines[i][1] == 0 or lines[i][1] < lines[i][0]]
    classes = brute.near_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    bad = brute.contamination(kept, database.execute("select item_id, text from benchmark").fetchall())
    want = {i: t for i, t in kept if not bad[i][3]}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in out} == want
    times: dict = {}
    for r in out:
        times.setdefault(r["doc_id"], []).append(r["mix_epoch"])
        assert r["n_chars"] == len(r["text"])
    assert all(sorted(e) == list(range(len(e))) and len(e) <= 2 for e in times.values())


def test_stages_take_odd_and_no_rows(spark, odd_docs):
    for docs in (odd_docs, odd_docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            assert n <= 2 * docs.count() if name == "mixing" else n <= docs.count()
            if name != "mixing":
                assert out.columns == docs.columns
