"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models; each
model also sees the probabilities of the categories before it. While training,
those come out of fold: a document's earlier probabilities are made by a model
that hasn't seen it, so later models learn how reliable they really are.

Features of a text are the distinct words in it (letters, lower case) and
their beginnings of three to five letters, each once however often it occurs:
a long text is not diluted, and inflected forms meet in their beginning. The
vocabulary keeps, per category, the ``VOCABULARY`` features whose presence
tells the classes best apart (chi-square) on the training rows, of those with the least support.

The models are fitted on at most ``SAMPLE`` labelled documents, those of
lowest hash of their id (the documented bound; all of them, if there are
fewer). Counting features is a Spark aggregation; the sparse matrix of the sample and
the vocabulary, both bounded by those parameters, are all that the driver
holds. Scoring runs over every document.

Defined results: a null or empty text has no features and gets the models'
base rates; labels of null count as unlabelled for their category only, labels of unknown documents are ignored, and of
labels that repeat for a document the highest counts; rows are scored
one by one, so repeats and null ids change nothing; without labelled documents, or if a category
has one class only, its probability is that class's share (0 without labels); an empty
table gives an empty result; other columns are ignored (``scores``) or kept (``clean``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.shared import cut, cuts_made, release

SAMPLE = 8_000
VOCABULARY = 2_000
SUPPORT = 3
FOLDS = 3
THRESHOLD = 0.5
PREFIXES = (3, 4, 5)
PENALTY = 1.0
PART = 250              # texts whose features are held at a time while scoring
CACHE_BYTES = 16 << 20  # of words met lately
_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """A word, and its beginnings (marked) if it is longer than they are."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


def features(text: str | None) -> set[str]:
    out: set[str] = set()
    for w in set(_LETTERS.findall((text or "").lower())):
        out.update(features_of(w))
    return out


@dataclass
class Logistic:
    """A logistic model over presence features and the probabilities of earlier categories."""
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def logit(self, rows: np.ndarray, columns: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=self.weights[columns], minlength=n) + before @ self.earlier + self.bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: np.ndarray, columns: np.ndarray, size: int, before: np.ndarray, y: np.ndarray, steps: int = 120) -> Logistic:
    """L2-penalised logistic regression on a sparse 0/1 matrix (row, column of each 1) by accelerated gradient steps.

    Coordinates are scaled by the root of their counts, which bounds the step.
    """
    n, m = len(y), before.shape[1]
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.0
        return Logistic(np.zeros(size), np.zeros(m), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    count = np.bincount(columns, minlength=size).astype(float)
    weigh = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))  # both classes count alike
    scale = np.concatenate([1 / np.sqrt(np.maximum(count, 1)), np.full(m + 1, 1 / np.sqrt(n))])
    dense = np.hstack([before, np.ones((n, 1))])

    def forward(v):
        return np.bincount(rows, weights=v[columns], minlength=n) + dense @ v[size:]

    def backward(r):
        return np.concatenate([np.bincount(columns, weights=r[rows], minlength=size), dense.T @ r])

    # the largest eigenvalue of the scaled Hessian, by power iteration
    v = np.ones(size + m + 1)
    for _ in range(15):
        v /= np.linalg.norm(v)
        v = scale * backward(weigh * forward(scale * v) / 4)
    bound = np.linalg.norm(v) * 1.05 + PENALTY
    x = z = np.zeros(size + m + 1)
    for k in range(steps):
        grad = scale * backward(weigh * (_sigmoid(forward(scale * z)) - y)) + PENALTY * z * (np.arange(len(z)) < size + m) * scale ** 2
        new = z - grad / bound
        z, x = new + k / (k + 3) * (new - x), new
    w = scale * x
    return Logistic(w[:size], w[size:size + m], float(w[-1]))


@dataclass
class Chain:
    """Models of the categories in order, over one vocabulary."""
    categories: tuple[str, ...]
    vocabulary: dict[str, int] = field(default_factory=dict)
    models: list[Logistic] = field(default_factory=list)

    def predict(self, rows: np.ndarray, columns: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros((n, 0))
        for model in self.models:
            out = np.hstack([out, _sigmoid(model.logit(rows, columns, n, out))[:, None]])
        return out


def fit_chain(categories: tuple[str, ...], vocabulary: dict[str, int], rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """Fit each category on the words and the out-of-fold probabilities of those before it.

    A link is fitted on the rows that have its own label (not NaN); rows without it still get its probability, from a model
    that hasn't seen them.
    """
    n, size = len(labels), len(vocabulary)
    before, chain = np.zeros((n, 0)), Chain(categories, vocabulary)

    def fit_on(some: np.ndarray, y: np.ndarray) -> Logistic:
        place, ones = np.cumsum(some) - 1, some[rows]
        return fit(place[rows[ones]], columns[ones], size, before[some], y[some])

    for c in range(len(categories)):
        y = labels[:, c].astype(float)
        known = ~np.isnan(y)
        chain.models.append(fit_on(known, y))
        if c + 1 == len(categories):
            break
        held_out = np.zeros(n)
        for f in range(FOLDS):
            held = fold == f
            held_out[held] = _sigmoid(fit_on(known & ~held, y).logit(rows, columns, n, before))[held]
        before = np.hstack([before, held_out[:, None]])
    return chain


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain of ``categories`` (name to a column over ``labels``, true or false) in their order."""
    before = cuts_made()
    chain = _train(docs, labels, categories, id_col, text_col)
    release(docs.sparkSession, before)
    return chain


def _train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str, text_col: str) -> Chain:
    names = tuple(categories)
    marked = (labels.select(labels[id_col].alias("doc"), *[c.cast("int").alias(f"y{k}") for k, c in enumerate(categories.values())])
              .where(" or ".join(f"y{k} is not null" for k in range(len(names)))).where("doc is not null")
              .groupBy("doc").agg(*[F.max(f"y{k}").alias(f"y{k}") for k in range(len(names))]))
    sample = cut(marked.withColumn("h", F.xxhash64("doc")).orderBy("h", "doc").limit(SAMPLE), "sample")
    ys = [f"y{k}" for k in range(len(names))]
    texts = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).join(sample, "doc").dropDuplicates(["doc"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 500):
                part = pdf.iloc[k:k + 500]
                yield part[["h", *ys]].assign(features=[sorted(features(t)) for t in part["text"]])
    rows = cut(texts.select("h", *ys, "text").mapInPandas(run, "h long, " + ", ".join(f"{y} int" for y in ys) + ", features array<string>"), "features")
    total = rows.agg(*[F.count(y).alias(f"n_{y}") for y in ys], *[F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in ys]).first()
    counted = (rows.select(F.explode("features").alias("feature"), *ys).groupBy("feature")
               .agg(*[F.count(y).alias(f"d_{y}") for y in ys], *[F.sum(y).alias(y) for y in ys]))
    chosen = []
    for k, y in enumerate(ys):
        # chi-square of presence against the category, over the rows that have its label; absent classes choose nothing
        n, p, d = total[f"n_{y}"], total[y], F.col(f"d_{y}")
        if n and 0 < p < n:
            expected = d * p / n
            gain = (F.col(y) - expected) ** 2 / (expected * (1 - F.lit(p) / n) * (1 - d / (n + 1)))
            chosen.append(counted.where(d >= SUPPORT).withColumn("gain", gain).orderBy(F.desc("gain"), "feature").limit(VOCABULARY).select("feature"))
    if not chosen:
        marks = _marks(rows.select(*ys).collect(), ys)
        return fit_chain(names, {}, np.zeros(0, int), np.zeros(0, int), marks, np.zeros(len(marks), int))
    kept = chosen[0]
    for more in chosen[1:]:
        kept = kept.union(more)
    vocabulary = {r[0]: i for i, r in enumerate(kept.distinct().orderBy("feature").collect())}  # VOCABULARY per category at most

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(features=[[vocabulary[f] for f in fs if f in vocabulary] for fs in pdf["features"]])
    placed = rows.mapInPandas(place, "h long, " + ", ".join(f"{y} int" for y in ys) + ", features array<int>")
    matrix = placed.orderBy("h").collect()  # SAMPLE rows of numbers below 2 * VOCABULARY
    lengths = np.array([len(r["features"]) for r in matrix])
    columns = np.array([c for r in matrix for c in r["features"]], dtype=np.int64)
    fold = np.array([r["h"] % FOLDS for r in matrix])
    return fit_chain(names, vocabulary, np.repeat(np.arange(len(matrix)), lengths), columns, _marks(matrix, ys), fold)


def _marks(rows: list, ys: list[str]) -> np.ndarray:
    """Labels by row and category, NaN where a row has none."""
    return np.array([[r[y] for y in ys] for r in rows], dtype=float).reshape(-1, len(ys))


def scores(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, p_<category>...) of every document."""
    return _scored(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), chain).select(
        F.col("id").alias(id_col), *[F.col("p")[k].alias(f"p_{c}") for k, c in enumerate(chain.categories)])


def _scored(rows: DataFrame, chain: Chain) -> DataFrame:
    """``rows`` with the array ``p`` of probabilities of their ``text``."""
    @F.pandas_udf("array<double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, tuple[int, ...]] = {}  # the vocabulary's part of each word met lately
        held = 0
        vocabulary = chain.vocabulary
        for texts in batches:
            made = []
            for start in range(0, len(texts), PART):    # features of some texts at a time
                found = []
                for t in texts.iloc[start:start + PART]:
                    here: set[int] = set()
                    for w in set(_LETTERS.findall((t or "").lower())):
                        at = known.get(w)
                        if at is None:
                            if held > CACHE_BYTES:
                                known.clear()
                                held = 0
                            at = known[w] = tuple([vocabulary[f] for f in features_of(w) if f in vocabulary])
                            held += 200 + len(w) + 8 * len(at)
                        here.update(at)
                    found.append(np.fromiter(sorted(here), dtype=np.int64, count=len(here)))
                columns = np.concatenate(found)
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                made += list(chain.predict(at, columns, len(found)))
            yield pd.Series(made)
    return rows.withColumn("p", predict("text"))


def table_categories(labels: DataFrame) -> dict[str, Column]:
    """The chain over a labels table (quality 0/1, toxic 0/1): low quality first, then toxic."""
    return {"low_quality": labels["quality"] == 0, "toxic": labels["toxic"] == 1}


def clean(docs: DataFrame, chain: Chain, category: str = "toxic", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose probability of ``category`` stays below ``threshold``."""
    rows = _scored(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("text")), chain)
    return (rows.where(F.col("p")[chain.categories.index(category)] < threshold)
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
