"""Quality classifier: positive-unlabelled learning.

Trusted positives (good texts of the training folds) and unlabelled web text are described by
statistics of the whole text; each statistic is cut at quantiles over all documents, and
a linear model over the intervals minimises the non-negative unbiased risk
`prior * R+(P) + max(0, R-(U) - prior * R-(P))`. The class prior is estimated: a first model
separates P from U, and the prior is the least ratio U(A) / P(A) over its upper level sets A,
with a margin for the sample's size. Bad labels are never used.

The unlabelled side is the whole table: its statistics are written once, then as a byte for each
interval, and each evaluation of a risk is a pass over these bytes that sums losses and gradients
(`treeAggregate`). L-BFGS needs few of them; a step that would bring the negative risk below
zero is shortened. `sample` bounds the positives that are fetched: rows of trusted ids, each id and
text once, picked by a hash of both. Every text is scored.

Cases: a null or empty text has the statistics of no characters and is scored like any other.
Without a trusted positive every score is 0.5. Repeated ids in the labels are averaged; a tie
is not a trusted positive. Repeated rows of a table are scored alike, and count as often as they are
there on the unlabelled side. Rows without id are unlabelled ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts, scratch, spare, spark_schema

#: Quantiles of the unlabelled texts at which a statistic is cut; a value at a cut is an interval of its own, so that zero is told from little.
QUANTILES = (0.002, 0.01, 0.03, 0.08, 0.2, 0.4, 0.6, 0.8, 0.92, 0.97, 0.99, 0.998)
BINS = 2 * len(QUANTILES) + 1
#: Weight of the squared norm for each statistic and text: the margin adds up over statistics, the evidence over texts.
DECAY = 1.0
#: Trusted texts that the fit sees at most.
SAMPLE = 10_000
#: Rounds of L-BFGS: for the model that estimates the prior, and for the risk.
ROUNDS = 12, 30
#: Rows of codes that a task sums at least.
ROWS = 200_000
_LATIN = np.zeros(256, bool)
_LATIN[[*range(65, 91), *range(97, 123)]] = True
_MARKS = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
_SENTENCE = np.array([ord(c) for c in ".,;:'\"()-?"])
_ODD = np.setdiff1d(_MARKS, _SENTENCE)
_RUN = re.compile(r"([^\w\s])\1")
NAMES = ("length", "words", "word_length", "upper", "digits", "odd", "sentence", "newlines", "beyond_ascii", "entropy", "distinct", "top_word", "repeats", "short", "bare", "marked", "long_words", "line_length", "same_lines", "runs", "marks")


def statistics(text: str) -> tuple[float, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    p = hist[hist > 0] / n
    letters = max(1, int(hist[_LATIN].sum() + hist[128:].sum()))
    words = text.split()
    w = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    return (
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / w, hist[65:91].sum() / letters, hist[48:58].sum() / n, hist[_ODD].sum() / w, hist[_SENTENCE].sum() / w, hist[10] / w, hist[128:].sum() / n,
        float(-(p * np.log2(p)).sum()), len(counts) / w, max(counts.values(), default=0) / w, sum(map(str.__eq__, words, words[1:])) / w, sum(len(x) * c < 4 * c for x, c in counts.items()) / w,
        sum(c for x, c in counts.items() if x.isalpha()) / w, sum(c for x, c in counts.items() if not x[-1].isalnum() and x[-1] not in ".,") / w, sum(c for x, c in counts.items() if len(x) > 20) / w,
        len(raw) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)), len(_RUN.findall(text)) / w, sum(c for x, c in counts.items() if not any(map(str.isalnum, x))) / w,
    )


def _interval(cuts: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, x, "left") + np.searchsorted(cuts, x, "right")


class Model:
    def __init__(self, cuts: np.ndarray, weights: np.ndarray, bias: float, prior: float):
        self.cuts, self.weights, self.bias, self.prior = cuts, weights, bias, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        """Of rows of statistics."""
        return self.of_codes(coded(x, self.cuts))

    def of_codes(self, codes: np.ndarray) -> np.ndarray:
        return _sigma(Design(codes).margins(np.append(self.weights.ravel(), self.bias)))


class Design:
    """Rows as the numbers of their intervals; stands for a 0/1 matrix with a column of ones."""

    def __init__(self, codes: np.ndarray):
        self.at = codes.astype(np.int64) + np.arange(codes.shape[1]) * BINS
        self.size, self.rows = codes.shape[1] * BINS + 1, len(codes)

    def margins(self, w: np.ndarray) -> np.ndarray:
        return w[self.at].sum(axis=1) + w[-1]

    def total(self, v: np.ndarray) -> np.ndarray:
        """The sum of v times the matrix's rows."""
        out = np.bincount(self.at.ravel(), np.repeat(v, self.at.shape[1]), self.size)
        out[-1] = v.sum()
        return out

    def negative(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss of these rows taken for negative ones, and its gradient."""
        z = self.margins(w)
        return float(np.logaddexp(0, z).sum()) / self.rows, self.total(_sigma(z)) / self.rows

    def above(self, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Share of rows with a margin of each cut or more."""
        return (np.sort(self.margins(w)).searchsorted(cuts, "left") * -1.0 + self.rows) / self.rows


class Codes:
    """The same of a table's column `code`: each answer is one pass over it."""

    def __init__(self, df: DataFrame, rows: int, features: int):
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, rows // ROWS)
        self.codes, self.rows, self.features, self.size = df.select("code").coalesce(tasks), rows, features, features * BINS + 1

    def summed(self, ask: Callable[[Design], np.ndarray], size: int) -> np.ndarray:
        features = self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    out += ask(Design(_codes(batch.column(0), features)))
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["m"])

        return self.codes.mapInArrow(run, "m binary").rdd.treeAggregate(np.zeros(size), lambda a, r: a + np.frombuffer(r.m), np.add, depth=2)

    def negative(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        def ask(d: Design) -> np.ndarray:
            z = d.margins(w)
            return np.append(d.total(_sigma(z)), np.logaddexp(0, z).sum())

        out = self.summed(ask, self.size + 1) / self.rows
        return float(out[-1]), out[:-1]

    def above(self, w: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return self.summed(lambda d: d.above(w, cuts) * d.rows, len(cuts)) / self.rows


def _codes(column: pa.Array, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, features)


def _sigma(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS from zero with backtracking; f gives a value and a gradient, infinity where it doesn't want to go."""
    w = np.zeros(size)
    value, g = f(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, weights = -g, []
        for s, y in reversed(past):
            weights.append(s @ d / (s @ y))
            d = d - weights[-1] * y
        if past:
            d = d * (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), x in zip(past, reversed(weights), strict=True):
            d = d + (x - y @ d / (s @ y)) * s
        rate, slope = 1.0 if past else 1.0 / max(1.0, float(np.linalg.norm(g))), float(g @ d)
        if slope > -1e-12:
            break
        while rate > 1e-4:
            then, h = f(w + rate * d)
            if then <= value + 1e-4 * rate * slope:
                break
            rate /= 4
        else:
            break
        if (h - g) @ d * rate > 1e-12:
            past = [*past[1 - memory :], (rate * d, h - g)]
        w, g, gained, value = w + rate * d, h, value - then, then
        if gained < 1e-5:
            break
    return w


def estimate_prior(p: np.ndarray, u: Callable[[np.ndarray], np.ndarray], rows: int) -> float:
    """Share of positives in u: the least U(A) / P(A) over upper level sets of a P-against-U model's margins; u tells the share above each cut."""
    cuts = np.quantile(p, np.linspace(0, 0.9, 91))
    upper_p, upper_u = np.array([(p >= c).mean() for c in cuts]), u(cuts)
    margin = np.sqrt(np.log(20) / (2 * len(p))) + np.sqrt(np.log(20) / (2 * rows))
    return float(np.clip(np.min((upper_u + margin) / np.maximum(upper_p, 1e-9)), 0.05, 0.99))


def fit(p: np.ndarray, u: Design | Codes, cuts: np.ndarray, prior: float | None = None) -> Model:
    """p: codes of trusted positives; u: the unlabelled texts."""
    if not len(p) or not u.rows:
        return Model(cuts, np.zeros((len(cuts), BINS)), 0.0, 0.5)
    xp = Design(p)
    if prior is None:

        def apart(w: np.ndarray) -> tuple[float, np.ndarray]:
            (loss, g), z = u.negative(w), xp.margins(w)
            return loss + np.logaddexp(0, -z).mean() + 5e-5 * w @ w, g - xp.total(_sigma(-z)) / xp.rows + 1e-4 * w

        half = minimise(apart, xp.size, ROUNDS[0])
        prior = estimate_prior(xp.margins(half), lambda at: u.above(half, at), u.rows)
    decay = DECAY * len(cuts) / min(len(p), u.rows)

    def risk(w: np.ndarray) -> tuple[float, np.ndarray]:
        (loss, g), z = u.negative(w), xp.margins(w)
        negative = loss - prior * np.logaddexp(0, z).mean()
        if negative < 0:
            return np.inf, g
        positive = prior * np.logaddexp(0, -z).mean()
        return positive + negative + decay / 2 * w @ w, g - prior * xp.total(np.ones(xp.rows)) / xp.rows + decay * w

    w = minimise(risk, xp.size, ROUNDS[1])
    return Model(cuts, w[:-1].reshape(len(cuts), BINS), float(w[-1]), prior)


def coded(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.stack([_interval(cuts[j], x[:, j]) for j in range(len(cuts))], axis=1).astype(np.uint8)


def described(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    return map_texts(df, keep, text_col, "x array<double>", lambda texts: [(statistics(t),) for t in texts])


def learn(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str = "quality", sample: int = SAMPLE) -> tuple[Model, DataFrame]:
    """The model, fitted on rows of `labels` outside fold 0 and on all rows of df, and (id, code) of these."""
    spark = df.sparkSession
    at = scratch(spark, "quality-statistics")
    named = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("hash"), F.col(f"`{text_col}`").cast("string").alias("text"))
    described(named, ["id", "hash"], "text").write.parquet(at)
    made = spark.read.parquet(at)
    each = [F.count("*").alias("n"), *[F.percentile_approx(F.col("x")[j], list(QUANTILES), 10_000).alias(f"q{j}") for j in range(len(NAMES))]]
    n, *quantiles = made.agg(*each).first()
    cuts = np.array(quantiles if n else np.zeros((len(NAMES), len(QUANTILES))), np.float64)
    told = spark_schema(f"id {made.schema['id'].dataType.simpleString()}, hash long, code binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                codes = coded(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), cuts)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], names=told.names)

    where = scratch(spark, "quality-codes")
    made.select("id", "hash", "x").mapInArrow(run, f"id {made.schema['id'].dataType.simpleString()}, hash long, code binary").write.parquet(where)
    codes = spark.read.parquet(where)
    good = (
        labels.where(fold(id_col) != 0).groupBy(F.col(f"`{id_col}`").alias("id")).agg(F.avg(label_col).alias("y")).where("y > 0.5")
        .orderBy(F.xxhash64("id"), "id").limit(sample).select("id")
    )
    # the sample has at most `sample` ids, so it may be broadcast; of an id's rows each text once
    trusted = codes.join(F.broadcast(good), "id", "left_semi").groupBy("id", "hash").agg(F.min("code").alias("code")).orderBy(F.xxhash64("id", "hash"), "id", "hash").limit(sample)
    fetched = [bytes(r.code) for r in trusted.select("code").collect()]
    p = np.frombuffer(b"".join(fetched), np.uint8).reshape(len(fetched), len(NAMES))
    return fit(p, Codes(codes, n, len(NAMES)), cuts), codes


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    return learn(df, labels, id_col, text_col, label_col, sample)[0]


def scored(df: DataFrame, model: Model, keep: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)
    return map_texts(df, keep, text_col, f"`{name}` double", lambda texts, m: [(float(s),) for s in m.score(np.array([statistics(t) for t in texts]))], lambda: shared.value)


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted; scored from the codes of the fit, without a second look at the texts."""
    model, codes = learn(df, labels, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = codes.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.of_codes(_codes(b.column(1), len(NAMES))))], names=["id", "score"])

    out = codes.select("id", "code").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
    return out.select(f"`{id_col}`", (fold(id_col) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of df that the classifier accepts, with df's columns."""
    keep, score = list(df.columns), spare(df, "score")
    made = scored(df, train(df, labels, id_col, text_col), keep, text_col, score)
    return made.where(F.col(score) >= threshold).select(*[F.col(f"`{c}`") for c in keep])
