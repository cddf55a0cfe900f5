"""Toxicity by a classifier chain: linear models, each fed the probabilities of the categories before it.

A category's model sees the words of a text and the earlier categories' probabilities. In training these are
out-of-fold: each row's come from a chain fitted on the other folds, so that later models learn from predictions as
unsure as those on new rows. Models are fitted on a bounded sample of the labelled rows (`sample`); all rows are scored.
"""

from __future__ import annotations


from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from millrace.llm.common import WORDS, carried, map_batches, restored, texts, with_columns

#: Labelled rows that the models are fitted on, by hash order; the only bound, and only on fitting.
SAMPLE = 4000
FOLDS = 3
PENALTY = 5e-4
REFIT = 2e-4
#: A fit ends where its optimality conditions hold up to this part of the penalty.
TOLERANCE = 1e-2
#: Columns that join a fit at a time.
TAKEN = 100
#: Word beginnings of so many characters count too, by whether they occur at least so many times.
PREFIXES = (5, 7)
STEPS = (1, 2, 4)
THRESHOLD = 0.25


def _features(text: bytes) -> set[str]:
    """Words, and how often word beginnings occur, as one name for each step reached."""
    words = Counter(text.translate(WORDS).decode(errors="replace").split())
    out = set(words)
    for k in PREFIXES:
        heads: Counter[str] = Counter()
        for w, n in words.items():
            if len(w) >= k:
                heads[w[:k]] += n
        for head, n in heads.items():
            out.update(f"{s} {head}" for s in STEPS if n >= s)
    return out


class Rows:
    """A sparse 0/1 matrix by rows, and dense columns for earlier probabilities."""

    def __init__(self, index: np.ndarray, lengths: np.ndarray, width: int, extra: np.ndarray):
        self.index, self.lengths, self.width, self.extra = index, lengths, width, extra
        self.row = np.repeat(np.arange(len(lengths)), lengths)

    def take(self, rows: np.ndarray) -> Rows:
        keep = np.zeros(len(self.lengths), bool)
        keep[rows] = True
        return Rows(self.index[keep[self.row]], self.lengths[keep], self.width, self.extra[keep])

    def only(self, chosen: np.ndarray) -> Rows:
        """The columns `chosen`, in that order."""
        place = np.full(self.width, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.index]
        use = at >= 0
        return Rows(at[use], np.bincount(self.row[use], minlength=len(self.lengths)).astype(np.int64), len(chosen), self.extra)

    def with_extra(self, columns: list[np.ndarray]) -> Rows:
        return Rows(self.index, self.lengths, self.width, np.column_stack(columns) if columns else np.zeros((len(self.lengths), 0)))

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        """The columns `chosen` of words, extras and intercept."""
        out = np.zeros((len(self.lengths), len(chosen)))
        place = np.full(self.width + self.extra.shape[1] + 1, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.index]
        out[self.row[at >= 0], at[at >= 0]] = 1
        for k in np.flatnonzero(chosen >= self.width):
            out[:, k] = np.column_stack([self.extra, np.ones(len(out))])[:, chosen[k] - self.width]
        return out

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.index], len(self.lengths)) + self.extra @ w[self.width : -1] + w[-1]

    def gradient(self, residual: np.ndarray) -> np.ndarray:
        words = np.bincount(self.index, residual[self.row], self.width)
        return np.concatenate([words, residual @ self.extra, [residual.sum()]]) / len(self.lengths)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: Rows, y: np.ndarray) -> np.ndarray:
    """Weights of the words, the extra columns and the intercept: selected under PENALTY, then fitted again under REFIT,
    so that the words which matter are not shrunk."""
    # A word in r of n rows has a slope below r / n, which must reach the penalty: leaving the others out changes no weight.
    often = np.flatnonzero(np.bincount(rows.index, minlength=rows.width) > PENALTY * len(y))
    first = _lasso(rows.only(often), y, PENALTY)
    has = np.flatnonzero(first[: len(often)])
    chosen = often[has]
    again = _lasso(rows.only(chosen), y, REFIT, np.concatenate([first[has], first[len(often) :]]))
    out = np.concatenate([np.zeros(rows.width), again[len(chosen) :]])
    out[chosen] = again[: len(chosen)]
    return out


def _lasso(rows: Rows, y: np.ndarray, strength: float, start: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression with an L1 penalty, to convergence; last weight is the intercept.

    The columns that break the optimality conditions most are taken in, until none does, under a limit that falls to
    TOLERANCE of the penalty. `start` is where to begin, not where to end.
    """
    n = rows.width + rows.extra.shape[1] + 1
    w = np.zeros(n)
    if not len(y) or y.min() == y.max():  # nothing is known of the category, or one answer only: no finite optimum
        w[-1] = 40 if len(y) and y[0] else -40
        return w
    penalty = np.full(n, strength)
    penalty[-1] = 0
    if start is not None:
        w = start.copy()
    active, last = np.append(np.flatnonzero(w[:-1]), n - 1), TOLERANCE * strength
    near = strength
    while True:
        w[active] = _newton(rows.dense(active), y, penalty[active], w[active], near)
        over = np.abs(rows.gradient(_sigmoid(rows.margins(w)) - y)) - penalty
        over[active] = 0
        worst = np.argsort(-over, kind="stable")[:TAKEN]
        worst = worst[over[worst] > max(last, near / 2)]
        if not len(worst) and near <= last:
            return w
        near = max(last, near / 5) if not len(worst) else near
        active = np.concatenate([active, worst])


def _newton(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, w: np.ndarray, tolerance: float) -> np.ndarray:
    """The weights of few dense columns by proximal Newton steps, each found by coordinate descent."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.mean(np.logaddexp(0, z) - y * z) + penalty @ np.abs(w))

    while True:
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) / len(y)
        off = np.where(w == 0, np.maximum(np.abs(slope) - penalty, 0), np.abs(slope + penalty * np.sign(w)))
        if off.max() <= tolerance:
            return w
        curve = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x / len(y)
        curve[np.diag_indices_from(curve)] += 1e-9
        new, bent = w.copy(), slope.copy()  # bent: the slope of the quadratic model at `new`
        near = max(tolerance / 10, off.max() / 10)  # a step need not be exact; the loop around it goes on until the weights are
        turn = np.arange(len(w))
        for _ in range(100):
            most = 0.0
            for j in turn.tolist():
                a = curve[j, j]
                at = new[j] - bent[j] / a
                at = np.sign(at) * max(abs(at) - penalty[j] / a, 0)
                if at != new[j]:
                    bent += (at - new[j]) * curve[j]
                    most, new[j] = max(most, a * abs(at - new[j])), at
            if most <= near and len(turn) == len(w):
                break
            turn = np.arange(len(w)) if most <= near else np.flatnonzero(new)
        step, here = new - w, loss(w)
        gain, part = slope @ step + penalty @ (np.abs(new) - np.abs(w)), 1.0
        while part > 1e-9 and loss(w + part * step) > here + 0.1 * part * gain + 1e-15:
            part /= 2
        if part <= 1e-9:  # no better weights within the precision of numbers
            return w
        w = new if part == 1 else w + part * step


def _chain(rows: Rows, labels: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """A weight vector for each column of labels; -1 there means unknown."""
    models: list[np.ndarray] = []
    earlier: list[np.ndarray] = []
    for k in range(labels.shape[1]):
        x, y = rows.with_extra(earlier), labels[:, k]
        known = np.flatnonzero(y >= 0)
        models.append(fit(x.take(known), y[known].astype(float)))
        if k + 1 == labels.shape[1]:
            break
        out = np.zeros(len(y))
        for f in range(FOLDS):
            inside = np.flatnonzero(fold == f)
            outside = np.flatnonzero((fold != f) & (y >= 0))
            out[inside] = _sigmoid(x.take(inside).margins(fit(x.take(outside), y[outside].astype(float))))
        earlier.append(out)
    return models


class Chain:
    """Fitted models of the categories: word weights that are not 0, weights of earlier probabilities, intercept."""

    def __init__(self, categories: list[str], models: list[tuple[dict[str, float], list[float], float]]):
        self.categories, self.models = categories, models
        self.known = [frozenset(words) for words, _, _ in models]

    def probabilities(self, text: bytes) -> list[float]:
        words, out = _features(text), []
        for known, (weights, before, intercept) in zip(self.known, self.models):
            z = intercept + sum(weights[x] for x in sorted(words & known)) + sum(w * p for w, p in zip(before, out))
            out.append(float(_sigmoid(np.float64(z))))
        return out


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Chain:
    """Fit the chain on at most `sample` labelled rows, those of the least hash.

    Rows without id, and labels that are null, count as unlabelled; of several labels of an id the largest
    counts, and of several texts the first in byte order. A category without any label has probability 0.
    """
    marks = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).cast("long").alias("doc_id")).agg(*[F.max(F.col(f"`{c}`").cast("int")).alias(f"y{k}") for k, c in enumerate(categories)])
    marks = marks.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)  # bounded by `sample`
    rows = carried(docs, id, text).join(F.broadcast(marks), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("h").alias("h"), *[F.first(f"y{k}").alias(f"y{k}") for k in range(len(categories))])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = pa.array([sorted(_features(t)) for t in texts(batch.column("text"))], pa.list_(pa.string()))
        return with_columns(batch.drop_columns(["text"]), words=words)

    schema = StructType([*(f for f in rows.schema if f.name != "text"), StructField("words", ArrayType(StringType()))])
    table = map_batches(rows, step, schema).toArrow().combine_chunks()
    order = np.lexsort((table["doc_id"].to_numpy(), table["h"].to_numpy())) if len(table) else np.zeros(0, np.int64)
    table = table.take(pa.array(order))
    y = np.column_stack([np.nan_to_num(table[f"y{k}"].to_numpy().astype(float), nan=-1) for k in range(len(categories))])
    return build(table["words"].combine_chunks(), np.minimum(y, 1).astype(np.int64), list(categories))


def build(words: pa.ListArray, labels: np.ndarray, categories: list[str]) -> Chain:
    """The chain from each row's distinct words and its labels, one column a category, -1 unknown."""
    flat = words.flatten().dictionary_encode()
    names = flat.dictionary.to_pylist()
    index = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(words.offsets.to_numpy()).astype(np.int64)
    n = len(names)
    models = _chain(Rows(index, lengths, n, np.zeros((len(lengths), 0))), labels, np.arange(len(lengths)) % FOLDS)
    return Chain(categories, [({names[i]: float(w[i]) for i in np.flatnonzero(w[:n])}, w[n:-1].tolist(), float(w[-1])) for w in models])


def _scored(rows: DataFrame, chain: Chain) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = [chain.probabilities(t) for t in texts(batch.column("text"))]
        return with_columns(batch, **{f"p_{c}": pa.array([x[k] for x in p], pa.float64()) for k, c in enumerate(chain.categories)})

    return map_batches(rows, step, StructType([*rows.schema, *(StructField(f"p_{c}", DoubleType()) for c in chain.categories)]))


def toxicity(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, p_<category> ..., rejected) for every document; rejected goes by the last category.

    Whole texts are scored; a null text is empty and gets the intercepts' probabilities. Repeated rows give
    the same answer each. Empty tables give no rows; without labels nothing is rejected.
    """
    chain = train(docs, labels, categories, id, text, sample)
    scored = _scored(carried(docs, id, text), chain)
    return scored.select("doc_id", *[f"p_{c}" for c in categories], (F.col(f"p_{categories[-1]}") > threshold).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that `toxicity` does not reject, all columns."""
    scored = _scored(carried(docs, id, text, rest=True), train(docs, labels, categories, id, text, sample))
    return restored(scored.where(F.col(f"p_{categories[-1]}") <= threshold), docs, text)
