"""Quality rules whose cutoffs are chosen so that few good documents are rejected, with stated risk."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import flat_bytes, read, small_batches, staged, text_of
from rivulet.llm.textscan import grouped, place_hashes, scan_words, shingles

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]
# Rule: value of a document, and cutoffs from strict to loose; a document is rejected above the cutoff.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
    "dup_lines": ("n_dup_lines / n_lines", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeat_words": ("n_repeat_words / n_words", (0.1, 0.15, 0.2, 0.3, 0.4)),
    "upper": ("n_upper / word_chars", (0.05, 0.1, 0.2, 0.4, 0.8)),
    "long_words": ("word_chars / n_words", (6.0, 7.0, 8.0, 10.0, 14.0)),
    "short_words": ("-1.0 * word_chars / n_words", (-4.0, -3.5, -3.0, -2.5, -2.0)),
}
FALSE_REJECTION = 0.05
RISK = 0.05
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_HEADS = (np.arange(256) & 0xC0) != 0x80
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def count_texts(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text, for all texts at once."""
    w, n = scan_words(raw, offsets, "spaced"), len(offsets) - 1
    heads = np.concatenate(([0], np.cumsum(_HEADS[w.data], dtype=np.int64)))
    chars = np.bincount(w.doc, weights=heads[w.ends] - heads[w.starts], minlength=n).astype(np.int64)
    out = {"n_words": w.counts, "word_chars": chars, "n_symbols": _sums(_SYMBOLS[raw], offsets), "n_upper": _sums(_UPPER[raw], offsets)}

    hashes, first = shingles(w, 3)
    order, new = grouped(w.doc[first], hashes)
    group = np.cumsum(new) - 1
    twice = first[order][np.bincount(group)[group] > 1] if len(order) else first
    covered = np.zeros(len(w.hashes), bool)
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=n)

    # Lines: texts are cut at \n; the separator byte in w.data belongs to none.
    stops = np.concatenate((np.flatnonzero(w.data == 10), w.begins[1:] - 1, [len(w.data)]))
    stops.sort()
    begins = np.concatenate(([0], stops[:-1] + 1))
    full = np.searchsorted(w.starts, stops) > np.searchsorted(w.starts, begins)
    begins, stops = begins[full], stops[full]
    doc = np.searchsorted(w.begins, begins, side="right") - 1
    line = place_hashes(w.data, begins, stops)
    order, new = grouped(doc, line)
    out["n_lines"] = np.bincount(doc, minlength=n)
    out["n_dup_lines"] = np.bincount(doc[order][~new], minlength=n)
    return {k: out[k].astype(np.int64) for k in COUNTS}


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pa.Array) -> pa.Array:
    parts = []
    for piece in small_batches([pa.record_batch([texts], ["t"])], "t"):
        counts = count_texts(*flat_bytes(piece.column(0)))
        parts.append(pa.StructArray.from_arrays([pa.array(counts[c]) for c in COUNTS], COUNTS))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(c, pa.int64()) for c in COUNTS]))


def counts_of(text: Column) -> Column:
    """Struct of the counts of a text; null counts as empty.

    Words are runs without space, tab, line breaks, vertical tab or form feed. ``n_repeat_words``:
    words inside 3-word runs found twice or more; ``n_dup_lines``: lines with a word, equal to an earlier one.
    """
    return _counts(text)


def _value(rule: str, of: str) -> Column:
    """The rule's value of a document, null where it has no words."""
    text = RULES[rule][0]
    for c in COUNTS:
        text = text.replace(c, f"{of}.{c}")
    return F.expr(f"CASE WHEN {of}.n_words > 0 THEN {text} END")


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial: the incomplete beta function I(1 - p; n - k, k + 1), whose cost doesn't grow with k."""
    if k >= n:
        return 1.0
    return incomplete_beta(n - k, k + 1, 1 - p)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _fraction(b, a, 1 - x) / b
    return front * _fraction(a, b, x) / a


def _fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return value


# All cutoffs, each with its place from loose to strict within its rule.
_TESTS = [(r, i, c) for r, (_, cuts) in enumerate(RULES.values()) for i, c in enumerate(sorted(cuts, reverse=True))]


def _accept(frames: Iterator[pd.DataFrame], rate: float, risk: float) -> Iterator[pd.DataFrame]:
    """Walks a stratum's path while each step's joint rejections prove a rate below ``rate``; the strictest cutoff of each rule on the way."""
    names = list(RULES)
    for f in frames:
        out: dict[str, list] = {"stratum": f["stratum"].tolist()} | {f"cut_{r}": [] for r in names}
        for n, path, rejected in zip(f["n"], f["path"], f["rejected"], strict=True):
            cuts: dict[int, float] = {}
            for (_, rule, cut), k in zip((tuple(p.values()) for p in path), rejected, strict=True):
                if not (k < rate * n and binomial_at_most(int(k), int(n), rate) <= risk):
                    break
                cuts[rule] = min(cut, cuts.get(rule, cut))
            for i, r in enumerate(names):
                out[f"cut_{r}"].append(cuts.get(i))
        yield pd.DataFrame(out).astype({f"cut_{r}": "float64" for r in names})


def choose_cutoffs(good: DataFrame, stratum: str, counts: str, false_rejection: float, risk: float, id_col: str = "doc_id") -> DataFrame:
    """One row per stratum: for each rule the strictest cutoff that is proven safe, else null.

    ``good`` holds the good documents of the labelled holdout. One half of them, by a hash of the id, puts all cutoffs of all
    rules into an order, from those that reject fewest on; the first t of them, taken together, are the t-th set of rules. The other half,
    which knows nothing of that order, tests the sets in this fixed sequence: a set is safe if, were the true rate at which it rejects
    good documents ``false_rejection`` or more, so few rejections as seen would have a chance of at most ``risk`` / strata (exact
    binomial bound, Bonferroni over strata). The sequence ends at the first set that fails, so its steps need no further correction, and with
    chance 1 - ``risk`` no stratum loses more than ``false_rejection`` of its good documents to all rules together. With 4 strata 86
    labels of the second half that a set spares prove it.
    """
    half = F.pmod(F.xxhash64(F.lit("half"), id_col), F.lit(2))
    values = F.array(*[_value(r, counts) for r in RULES])
    rows = good.select(F.col(stratum).alias("stratum"), half.alias("half"), values.alias("values"))
    hits = [F.count_if((F.col("half") == 0) & (F.get("values", F.lit(r)) > c)).alias(f"t{t}") for t, (r, _, c) in enumerate(_TESTS)]
    table = staged(rows.groupBy("stratum").agg(F.count("*").alias("n"), *hits))
    steps = [F.struct(F.col(f"t{t}").alias("k"), F.lit(i).alias("i"), F.lit(r).alias("rule"), F.lit(float(c)).alias("cut")) for t, (r, i, c) in enumerate(_TESTS)]
    ordered = F.transform(F.sort_array(F.array(*steps)), lambda s: F.struct(s["k"].alias("k"), s["rule"].alias("rule"), s["cut"].alias("cut")))
    paths = table.select(F.col("stratum").alias("stratum_"), ordered.alias("path"))
    tested = rows.where("half = 1").join(paths, F.col("stratum").eqNullSafe(F.col("stratum_")))
    first = F.array_min(F.transform("path", lambda s, t: F.when(F.get("values", s["rule"]) > s["cut"], t)))
    tested = tested.select("stratum", F.coalesce(first, F.lit(len(_TESTS))).alias("first"))
    spared = [F.count_if(F.col("first") <= t) for t in range(len(_TESTS))]
    tested = tested.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*spared).alias("rejected"))
    tested = tested.join(paths, F.col("stratum").eqNullSafe(F.col("stratum_"))).select("stratum", "n", "path", "rejected")
    strata = max(1, table.count())
    kind = table.schema["stratum"].dataType.simpleString()
    schema = f"stratum {kind}, " + ", ".join(f"cut_{r} double" for r in RULES)
    return tested.mapInPandas(lambda frames: _accept(frames, false_rejection, risk / strata), schema)


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    false_rejection: float = FALSE_REJECTION,
    risk: float = RISK,
    keep_text: bool = True,
) -> DataFrame:
    """All rows with ``rule_counts`` (struct), ``base_failed``, ``failed_rules`` and ``kept``.

    ``labels`` has ``id_col`` and ``quality`` (1: good). Null texts have no words and fail the base
    rule; a null stratum is a stratum of its own; rows without id have no label; of labels that
    repeat an id, good ones count once per row of that id; repeated rows are judged alike; a stratum with too few
    labels, or a table without labels, gets no cutoffs and keeps all that pass the base rule. Columns
    with the names of the results are replaced.
    """
    names = ["rule_counts", "base_failed", "failed_rules", "kept"]
    docs = docs.drop(*names)
    counted = docs.withColumn("rule_counts", counts_of(text_of(text_col)))
    if keep_text:  # counted once, for the cutoffs and the verdicts
        counted = staged(counted)
    narrow = counted.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"), "rule_counts")
    narrow = narrow if keep_text else staged(narrow)
    good = labels.where("quality = 1").select(F.col(id_col).alias("doc_id")).distinct()
    base_failed = F.expr(BASE_FAILED.replace("n_", "rule_counts.n_"))
    cutoffs = choose_cutoffs(narrow.join(good, "doc_id").where(~base_failed), "stratum", "rule_counts", false_rejection, risk)
    cutoffs = staged(cutoffs.withColumnRenamed("stratum", "stratum_"))
    if not keep_text:  # the counts are there already; texts are not read again
        counted = narrow.withColumnsRenamed({"doc_id": id_col, "stratum": stratum_col})
    judged = counted.join(cutoffs, F.col(stratum_col).eqNullSafe(F.col("stratum_")), "left").withColumn("base_failed", base_failed)
    failed = F.filter(
        F.array(*[F.when(_value(r, "rule_counts") > F.col(f"cut_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull()
    )
    judged = judged.withColumn("failed_rules", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return judged.drop("stratum_", *[f"cut_{r}" for r in RULES])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, cutoffs from all labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = apply_rules(docs, read(spark, sf_dir, "labels"), keep_text=False)
    counts = [F.col(f"rule_counts.{c}").alias(c) for c in COUNTS[:5]]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))
