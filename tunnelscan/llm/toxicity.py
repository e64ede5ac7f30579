"""Severity of toxicity by cumulative-link ordinal regression.

Grades are ordered 0 < 1 < ... < K.  One weight vector is shared by all
thresholds: P(grade > k) = 1 / (1 + exp(t_k - w.x)), with t_0 < t_1 < ...; the
expected severity is the sum of these over k.  Features are the distinct words
and beginnings of words of a text, hashed.  The fit maximises the likelihood with an L1 penalty on w
(accelerated proximal gradient), which leaves few words with a weight.

The model is fitted on a bounded sample: the ``sample_rows`` labelled documents
with the smallest hash of their id.  Scoring covers every whole text.

Words: A-Z lower-cased, maximal runs of 0-9, a-z and bytes from 0x80.

Edge cases: a NULL or empty text has no words and the severity of the bare
thresholds; labels without a document, documents without a label and labels
with a NULL grade take no part in the fit; repeated labels count once (the
highest grade), as do repeated documents; without two grades in the sample every severity is that of the
only grade (0 when there is none); repeated rows give a row each; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import (as_strings, batch_of, flat, id_text, keyed, keyed_batch, list_array, mix, row_text,
                                   slices, span_hashes, span_tables, word_spans)

SAMPLE_ROWS = 10_000
BITS = 18
L1 = 0.02
L2 = 0.001
STEPS = 200
# Grade from which a document is toxic, and the probability asked for it.
TOXIC_GRADE = 2
REJECT = 0.4
# Beginnings of words, in bytes, that are features besides the whole words.
PREFIXES = (4, 5, 6, 7, 8, 9)
# Documents a feature must have in the sample to get a weight.
MIN_DOCUMENTS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def severity_grade(quality: Column, toxic: Column) -> Column:
    """0 unobjectionable, 1 poor but not toxic, 2 toxic; NULL without a label.

    Toxicity is the top grade whatever the quality: with one weight vector, a
    grade above it would hold down the weights of what makes a text toxic.
    """
    return F.when(toxic == 1, 2).when(toxic == 0, F.when(quality == 0, 1).otherwise(0))


def word_slots(col: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature number of every feature of a string array."""
    data, offs = flat(col)
    data = _LOWER[data]
    starts, ends, row = word_spans(data, offs, _IS_WORD)
    tables = span_tables(data)
    rows, slots = [row], [span_hashes(data, starts, ends, tables)]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        rows.append(row[long])
        # Another seed than that of whole words.
        slots.append(mix(span_hashes(data, starts[long], starts[long] + k, tables) + np.uint64(k)))
    shift = np.uint64(64 - bits)
    return np.concatenate(rows), (np.concatenate(slots) >> shift).astype(np.int64)


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray      # 2 ** bits
    thresholds: np.ndarray   # ascending, one less than grades
    bits: int = BITS

    def exceeds(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every row and k."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))

    def scores(self, col: pa.Array) -> np.ndarray:
        """w.x of every text: the weights of its distinct words."""
        row, slot = word_slots(col, self.bits)
        used = np.flatnonzero(self.weights[slot])
        pairs = np.unique((row[used] << self.bits) | slot[used])
        return np.bincount(pairs >> self.bits, weights=self.weights[pairs & ((1 << self.bits) - 1)],
                           minlength=len(col))


def _features(bits: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("slots", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            col = as_strings(batch.column(1))
            for a, b in slices(col):
                row, slot = word_slots(col.slice(a, b - a), bits)
                pairs = np.unique((row << bits) | slot)
                offs = np.searchsorted(pairs >> bits, np.arange(b - a + 1))
                yield batch_of(kinds, batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                               list_array(pairs & ((1 << bits) - 1), offs, pa.int32()))
    return run


def _terms(grades, score, t):
    """Probability of each row's grade, and F, f at its lower and upper bound."""
    bounds = np.r_[-np.inf, t, np.inf]
    upper = 1.0 / (1.0 + np.exp(np.clip(score - bounds[grades + 1], -500, 500)))
    lower = 1.0 / (1.0 + np.exp(np.clip(score - bounds[grades], -500, 500)))
    return np.maximum(upper - lower, 1e-300), lower, upper, lower * (1 - lower), upper * (1 - upper)


def _by_score(grades, score, t):
    """Derivative of the mean negative log-likelihood by each row's score."""
    p, _, _, f_low, f_up = _terms(grades, score, t)
    return (f_up - f_low) / p / len(grades)


def _select(grades, rows, slots, t, scale, l1: float, steps: int) -> np.ndarray:
    """Features with a weight under the L1 penalty, thresholds held: FISTA with
    backtracking on standardised features."""
    n, size = len(grades), len(scale)
    total = lambda w: np.bincount(rows, weights=(w * scale)[slots], minlength=n)
    loss = lambda w: -np.log(_terms(grades, total(w), t)[0]).mean()
    w = z = np.zeros(size)
    momentum = step = 1.0
    for _ in range(steps):
        now = loss(z)
        g = np.bincount(slots, weights=_by_score(grades, total(z), t)[rows], minlength=size) * scale
        while True:
            new = z - step * g
            new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0.0)
            d = new - z
            if loss(new) <= now + g @ d + d @ d / (2 * step) + 1e-12 or step < 1e-6:
                break
            step /= 2
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        z, moved = new + (momentum - 1) / following * (new - w), np.abs(new - w).max(initial=0.0)
        w, momentum, step = new, following, step * 1.2
        if moved < 1e-3:
            break
    return w != 0


def _newton(grades, rows, slots, t, scale, l2: float, steps: int = 40):
    """(w, t) of the few selected features under the L2 penalty."""
    n, m, k = len(grades), len(scale), len(t)
    x = np.zeros((n, m))
    x[rows, slots] = scale[slots]
    w = np.zeros(m)
    penalty = np.r_[np.full(m, l2), np.zeros(k)]

    def loss(w, t):
        return -np.log(_terms(grades, x @ w, t)[0]).mean() + l2 / 2 * (w @ w)

    for _ in range(steps):
        p, low, up, f_low, f_up = _terms(grades, x @ w, t)
        d_up = np.hstack([-x, np.eye(k + 1)[grades][:, :k]])        # of the bounds by (w, t)
        d_low = np.hstack([-x, np.eye(k + 1)[grades - 1][:, :k]])
        d_low[grades == 0, m:] = 0.0
        g = (d_low.T @ (f_low / p) - d_up.T @ (f_up / p)) / n + penalty * np.r_[w, t]
        a = (f_up / p) ** 2 - f_up * (1 - 2 * up) / p
        b = (f_low / p) ** 2 + f_low * (1 - 2 * low) / p
        c = -(f_up / p) * (f_low / p)
        cross = d_up.T @ (d_low * c[:, None])
        h = (d_up.T @ (d_up * a[:, None]) + d_low.T @ (d_low * b[:, None]) + cross + cross.T) / n
        move = np.linalg.solve(h + np.diag(penalty + 1e-9), -g)
        now, step = loss(w, t), 1.0
        while step > 1e-6:
            w_new, t_new = w + step * move[:m], t + step * move[m:]
            if np.all(np.diff(t_new) > 0) and loss(w_new, t_new) <= now + 1e-4 * step * (g @ move):
                break
            step /= 2
        else:
            break
        w, t = w_new, t_new
        if -(g @ move) < 1e-10:
            break
    return w, t


def fit_ordinal(grades: np.ndarray, rows: np.ndarray, slots: np.ndarray, bits: int = BITS, l1: float = L1,
                l2: float = L2, steps: int = STEPS, min_documents: int = MIN_DOCUMENTS) -> OrdinalModel:
    """Fit on sparse rows: feature ``slots[i]`` is set in row ``rows[i]``."""
    weights = np.zeros(1 << bits)
    levels, grades = np.unique(grades, return_inverse=True)
    if len(levels) < 2:
        # A single grade: all mass above the thresholds below it.
        only = int(levels[0]) if len(levels) else 0
        return OrdinalModel(weights, np.full(only, -40.0) if only else np.array([40.0]), bits)
    n = len(grades)
    share = np.array([(grades > k).mean() for k in range(len(levels) - 1)])
    t = np.log((1 - share) / share)
    # Half the penalty is the least slope at the start that a feature needs.
    held = np.bincount(slots, minlength=1 << bits)
    slope = np.bincount(slots, weights=_by_score(grades, np.zeros(n), t)[rows], minlength=1 << bits)
    keep = (held >= min_documents) & (np.abs(slope) * np.sqrt(n / np.maximum(held, 1)) >= l1 / 2)
    for last in (False, True):
        rows, slots = rows[keep[slots]], slots[keep[slots]]
        used, at, held = np.unique(slots, return_inverse=True, return_counts=True)
        scale = np.sqrt(n / held)
        if last:
            w, t = _newton(grades, rows, at, t, scale, l2)
            weights[used] = w * scale
        else:
            keep = np.zeros(1 << bits, dtype=bool)
            keep[used[_select(grades, rows, at, t, scale, l1, steps)]] = True
    # A grade missing from the sample has the threshold of the next one below it.
    return OrdinalModel(weights, t[np.searchsorted(levels[1:], np.arange(1, levels[-1] + 1))], bits)


def fit(documents: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
        label_id_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS, bits: int = BITS, **options) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labelled documents (their hashed features,
    about 1 kB each, are what reaches the driver)."""
    graded = labels.select(F.col(f"`{label_id_col}`").cast("long").alias("i"), grade.cast("int").alias("grade"))
    graded = graded.where("i is not null and grade is not null").groupBy("i").agg(F.max("grade").alias("grade"))
    docs = id_text(documents, id_col, text_col)
    held = graded.join(docs.select(F.col("doc_id").alias("i")), "i", "left_semi")
    chosen = held.orderBy(F.xxhash64("i"), "i").limit(sample_rows)
    sample = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("i")).select("doc_id", "text", "grade")
    # Rows of the same id are one document here.
    rows = (sample.mapInArrow(_features(bits), "doc_id long, grade int, slots array<int>")
            .dropDuplicates(["doc_id"]).toArrow())
    lists = rows["slots"].combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    at = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False)) \
        if rows.num_rows else np.empty(0, np.int64)
    return fit_ordinal(rows["grade"].to_numpy().astype(np.int64), at,
                       lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), bits, **options)


def _score(model):
    kinds = pa.schema([("doc_id", pa.int64()), ("exceeds", pa.list_(pa.float64())), ("severity", pa.float64()),
                       ("grade", pa.int32())])

    def run(batches):
        m = OrdinalModel(*model.value)
        for batch in batches:
            col = as_strings(batch.column(1))
            for a, b in slices(col):
                p = m.exceeds(m.scores(col.slice(a, b - a)))
                yield keyed_batch(kinds, batch.column(0).slice(a, b - a),
                                  list_array(p.ravel(), np.arange(b - a + 1) * p.shape[1], pa.float64()),
                                  p.sum(axis=1), (p > 0.5).sum(axis=1).astype(np.int32))
    return run


def severity(documents: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
             whole_rows: bool = False) -> DataFrame:
    """``doc_id``, ``exceeds`` (P(grade > k) by k), expected ``severity`` and
    the most likely ``grade`` by the median of every document; with ``whole_rows``
    the struct ``row`` of all columns in place of the id."""
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.thresholds, model.bits))
    df = row_text(documents, text_col) if whole_rows else id_text(documents, id_col, text_col)
    return df.mapInArrow(_score(shared), keyed(df, "exceeds array<double>, severity double, grade int"))


def is_toxic() -> Column:
    """P(grade >= TOXIC_GRADE) is at least REJECT (false where the model has no such grade)."""
    return F.coalesce(F.try_element_at("exceeds", F.lit(TOXIC_GRADE)) >= REJECT, F.lit(False))


def op9_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(documents, labels, severity_grade(F.col("quality"), F.col("toxic")))
    return severity(documents, model).select("doc_id", "severity", "grade", is_toxic().alias("toxic"))
