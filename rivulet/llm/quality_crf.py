"""Document quality from a linear-chain conditional random field that labels each line good or bad."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import flat_bytes, read, small_batches, text_of
from rivulet.llm.textscan import grouped, place_hashes, scan_words, shingles

TRAIN_DOCS = 4000  # about so many labelled documents are fetched to fit the weights; scoring covers all rows
STEPS, RATE, PENALTY = 150, 0.1, 1e-4


def _class(letters: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(letters))


_CLASSES = [_class(bytes(range(65, 91))), _class(b"0123456789"), _class(b"#*$%&<>@{}[]=_"), _class(b"!?"), _class(b".,;:"), _class(b"|"), np.arange(256) >= 128]
_HEADS = (np.arange(256) & 0xC0) != 0x80
OWN = len(_CLASSES) + 11


def line_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line with a word, its text's number, and its weight (code points).

    The features of the line before and the line after stand behind its own. A text without
    words has one empty line.
    """
    n = len(offsets) - 1
    w = scan_words(raw, offsets, "spaced")
    stops = np.sort(np.concatenate((np.flatnonzero(w.data == 10), w.begins[1:] - 1, [len(w.data)])))
    begins = np.concatenate(([0], stops[:-1] + 1))
    lo, hi = np.searchsorted(w.starts, begins), np.searchsorted(w.starts, stops)
    text = np.searchsorted(w.begins, begins, side="right") - 1
    empty = np.zeros(len(begins), bool)
    empty[np.searchsorted(text, np.flatnonzero(w.counts == 0))] = True
    on = (hi > lo) | empty
    begins, stops, lo, hi, text = begins[on], stops[on], lo[on], hi[on], text[on]
    m = len(begins)

    def share(flags: np.ndarray, a: np.ndarray, b: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (total[b] - total[a]) / np.maximum(of, 1)

    words, size = hi - lo, stops - begins
    chars = share(_HEADS[w.data], begins, stops, np.ones(m)) if m else np.zeros(0)
    columns = [share(c[w.data], begins, stops, size) for c in _CLASSES]
    length = w.ends - w.starts
    line_of = np.repeat(np.arange(m), words)
    first = w.data[w.starts] if len(w.starts) else np.zeros(0, np.uint8)
    same = np.zeros(len(w.hashes), bool)
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.doc[1:] == w.doc[:-1])
    order, new = grouped(line_of, w.hashes)
    distinct = np.bincount(line_of[order[new]], minlength=m) if len(order) else np.zeros(m)
    hashes = place_hashes(w.data, begins, stops)
    order, new = grouped(text, hashes)
    group = np.cumsum(new) - 1
    copies = np.empty(m)
    copies[order] = np.bincount(group)[group] if m else 0
    # Of the whole text: size, share of distinct words, share of distinct runs of three words.
    order, new = grouped(w.doc, w.hashes)
    vocabulary = np.bincount(w.doc[order[new]], minlength=n) / np.maximum(w.counts, 1)
    runs, at = shingles(w, 3)
    order, new = grouped(w.doc[at], runs)
    fresh = (np.bincount(w.doc[at[order[new]]], minlength=n) + 1) / (np.bincount(w.doc[at], minlength=n) + 1)
    columns += [
        np.log1p(words),
        np.log1p(share(length, lo, hi, words)),
        share((first >= 65) & (first <= 90), lo, hi, words),
        share(length >= 14, lo, hi, words),
        share(length <= 2, lo, hi, words),
        share(same, lo, hi, words),
        distinct / np.maximum(words, 1),
        np.log(np.maximum(copies, 1)),
        np.log1p(w.counts)[text],
        vocabulary[text],
        fresh[text],
    ]
    own = np.stack(columns, axis=1) if m else np.zeros((0, OWN))
    before, after = np.zeros_like(own), np.zeros_like(own)
    if m > 1:
        joined = (text[1:] == text[:-1])[:, None]
        before[1:] = own[:-1] * joined
        after[:-1] = own[1:] * joined
    return np.concatenate((own, before, after), axis=1), text, np.maximum(chars, 1)


def _padded(text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of n texts as a table: order of texts (long ones first), place of each line in it, lines per text."""
    lines = np.bincount(text, minlength=n)
    order = np.argsort(-lines, kind="stable")
    row = np.empty(n, np.int64)
    row[order] = np.arange(n)
    return row[text], np.arange(len(text)) - (np.cumsum(lines) - lines)[text], lines[order]


def forward_backward(emission: np.ndarray, step: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Chance of each line to be good, expected numbers of label pairs, log of all sums.

    ``emission`` is the log weight of good against bad of each line, ``step`` those of label pairs. Lines come text by text.
    Texts are dealt with in groups of about the same number of lines, whose table of lines by texts has at most ``CELLS``
    cells (a text with more lines is a group of its own), so a long text beside many short ones needs no more memory.
    """
    lines = np.bincount(text, minlength=n)
    order = np.argsort(-lines, kind="stable")
    first = np.cumsum(lines) - lines
    good, pairs, total = np.zeros(len(text)), np.zeros((2, 2)), 0.0
    begin = 0
    while begin < n:
        end = min(n, begin + max(1, CELLS // max(1, int(lines[order[begin]]))))
        group = order[begin:end]
        sizes = lines[group]
        at = np.repeat(first[group] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        g, p, t = _forward_backward(emission[at], step, np.repeat(np.arange(len(group)), sizes), len(group))
        good[at] = g
        pairs, total, begin = pairs + p, total + t, end
    return good, pairs, total


def _forward_backward(emission: np.ndarray, step: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    row, column, lines = _padded(text, n)
    deep = int(lines[0]) if n else 0
    table = np.zeros((deep, n, 2))
    table[column, row, 1] = emission
    forward, backward = np.zeros_like(table), np.zeros_like(table)
    alive = [int(np.searchsorted(-lines, -t, side="left")) for t in range(deep)]  # texts with more than t lines
    forward[0] = table[0]
    for t in range(1, deep):
        k = alive[t]
        forward[t, :k] = np.logaddexp.reduce(forward[t - 1, :k, :, None] + step, axis=1) + table[t, :k]
    for t in range(deep - 1, 0, -1):
        k = alive[t]
        backward[t - 1, :k] = np.logaddexp.reduce(step + (table[t, :k] + backward[t, :k])[:, None, :], axis=2)
    total = np.logaddexp.reduce(forward[lines - 1, np.arange(n)], axis=1)
    good = np.exp(forward[column, row, 1] + backward[column, row, 1] - total[row])
    pairs = np.zeros((2, 2))
    for t in range(1, deep):
        k = alive[t]
        joint = forward[t - 1, :k, :, None] + step + (table[t, :k] + backward[t, :k])[:, None, :] - total[:k, None, None]
        pairs += np.exp(joint).sum(axis=0)
    return good, pairs, float(total.sum())


CELLS = 1 << 20


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    step: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw_scores(self, x: np.ndarray, text: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        emission = ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        good, _, _ = forward_backward(emission, self.step, text, n)
        return np.bincount(text, weights=good * weight, minlength=n) / np.bincount(text, weights=weight, minlength=n)

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x, text, weight = line_features(raw, offsets)
        return self.calibrated(self.raw_scores(x, text, weight, len(offsets) - 1))

    def calibrated(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(score) + self.shift)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def fit(raw: np.ndarray, offsets: np.ndarray, quality: np.ndarray, steps: int = STEPS) -> Model:
    """Conditional likelihood of the labels, each line having that of its document; then a logistic calibration of the scores.

    Documents weigh alike, however many lines they have.
    """
    n = len(quality)
    x, text, weight = line_features(raw, offsets)
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(x.shape[1] + 1), np.zeros((2, 2)))
    z = np.concatenate(((x - model.mean) / model.scale, np.ones((len(x), 1))), axis=1)
    gold = quality[text].astype(np.float64)
    lines = np.bincount(text, minlength=n)
    share = 1 / np.maximum(lines, 1)[text]
    stays = np.array([((quality == v) * np.maximum(lines - 1, 0)).sum() for v in (0, 1)], np.float64)
    moment, spread = np.zeros(len(model.weights) + 4), np.zeros(len(model.weights) + 4)
    for t in range(1, steps + 1):
        good, pairs, _ = forward_backward(z @ model.weights, model.step, text, n)
        slope = np.concatenate(((z * ((gold - good) * share)[:, None]).sum(axis=0), ((np.diag(stays) - pairs) * n / max(1, len(text))).reshape(-1)))
        slope = slope / n - PENALTY * np.concatenate((model.weights, 100 * model.step.reshape(-1)))
        moment, spread = 0.9 * moment + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
        move = RATE * (moment / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.999**t)) + 1e-8)
        model.weights = model.weights + move[:-4]
        model.step = model.step + move[-4:].reshape(2, 2)
    v = _logit(model.raw_scores(x, text, weight, n))
    a = np.array([1.0, 0.0])
    base = np.stack((v, np.ones(n)), axis=1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(base @ a, -30, 30)))
        bend = (base * (p * (1 - p))[:, None]).T @ base + 1e-2 * np.eye(2)
        a = a + np.linalg.solve(bend, base.T @ (quality - p) - 1e-2 * (a - [1.0, 0.0]))
    model.slope, model.shift = float(max(a[0], 1e-3)), float(a[1])
    return model


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Model | None:
    """Fit on about ``train_docs`` labelled rows that are not held out, taken by a hash of the id; None if there are none."""
    known = labels.where(F.col("quality").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_quality"))
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("_id", F.lit("crf")), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, train_docs / max(1, n)))))
    rows = docs.join(chosen, docs[id_col] == F.col("_id")).select("_id", "_quality", text_of(text_col).alias("_body")).toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("_id", "ascending"), ("_body", "ascending")])
    return fit(*flat_bytes(rows["_body"]), rows["_quality"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id held_out score predicted`` (score: 0 to 1, higher means better).

    Null texts are empty and score as one empty line; a null id is not held out; repeated rows
    score alike; other columns are ignored. Without a model (no labels) all score 0.5.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            s = model.scores(*flat_bytes(b.column("text"))) if model else np.full(b.num_rows, 0.5)
            yield pa.record_batch(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a field fitted on labelled ones that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, read(spark, sf_dir, "labels").select("doc_id", "quality")))
