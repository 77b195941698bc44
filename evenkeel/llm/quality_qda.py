"""Document quality by regularised quadratic discriminant analysis over text statistics.

Each text becomes a short vector: how long it is, and shares of characters, words and lines that
tell prose from junk, each under a transform that steadies its variance. Per class the mean and
covariance come from sums over all labelled training rows, which tasks reduce before anything
moves. A class covariance is shrunk towards the pooled one and both towards their mean variance;
its Cholesky factor is inverted once, and the score rests on the difference of the Gaussian
log-densities. A logistic curve fitted to the histogram of that difference over the same rows, by
class, turns it into a probability.

Texts are turned into statistics in arrays over the bytes of an Arrow batch, in bounded runs;
texts are not shuffled. What reaches the driver is one matrix per class and one small histogram.

Defined cases: a null text is an empty one, whose shares are 0; rows without a label are not
learnt from; a row with several labels is learnt from once for each; without both classes in
training every score is the smoothed share of label 1; repeated rows are scored each; very long
texts are read whole; extra columns pass through, and a clash with the names of the results is an
error; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from evenkeel.llm.textbytes import Run, mixed, runs, word_hashes, word_spans
from evenkeel.session import materialize

THRESHOLD = 0.3


def byte_set(chars: str | range) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[[ord(c) for c in chars] if isinstance(chars, str) else list(chars)] = 1
    return table


# Counted over bytes: characters (every byte that starts one) and kinds of them.
KINDS = {
    "chars": 1 - byte_set(range(0x80, 0xC0)),
    "symbols": byte_set("#*$%&|<>@^~_=+\\{}[]"),
    "shouts": byte_set("!?"),
    "stops": byte_set(".,;:"),
    "capitals": byte_set(range(ord("A"), ord("Z") + 1)),
    "digits": byte_set(range(ord("0"), ord("9") + 1)),
    "lines": byte_set("\n"),
}
TALLIES = (*KINDS, "words", "word_chars", "repeats", "single")
STATISTICS = (
    "size", "word_length", "symbols", "shouts", "stops", "capitals", "digits", "lines", "repeats", "single", "variety", "echo",
)


def run_tallies(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts per piece (columns of TALLIES); every word's hash and its piece."""
    region, bounds = run.region, run.bounds
    out = np.zeros((run.rows.size, len(TALLIES)))
    starts, ends, piece = word_spans(run)
    if region.size:
        some = np.flatnonzero(run.ends > run.starts)
        for j, table in enumerate(KINDS.values()):
            out[some, j] = np.add.reduceat(table[region], bounds[some])
    hashes = word_hashes(region, starts, ends)
    again = np.zeros(hashes.size)
    again[1:] = (hashes[1:] == hashes[:-1]) & (piece[1:] == piece[:-1])
    leads = np.append(0, np.cumsum(KINDS["chars"][region]))
    lengths = (leads[ends] - leads[starts]) if starts.size else np.zeros(0)
    for name, weights in (("words", None), ("word_chars", lengths), ("repeats", again), ("single", (lengths == 1).astype(float))):
        out[:, TALLIES.index(name)] = np.bincount(piece, weights, run.rows.size)
    return out, hashes, piece


def distinct_share(hashes: np.ndarray, rows: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Per row how many of its hashes are different, as a share of ``total``."""
    keys = np.unique(mixed(hashes) ^ mixed(rows.astype(np.uint64)), return_index=True)[1]
    return np.bincount(rows[keys], minlength=n) / np.maximum(total, 1)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    n = len(column)
    tallies = np.zeros((n, len(TALLIES)))
    variety, echo = np.zeros(n), np.zeros(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def settle() -> None:
        """Distinct words and pairs of the texts that are complete."""
        if not held:
            return
        hashes, rows = (np.concatenate(x) for x in zip(*held))
        held.clear()
        if not rows.size:
            return
        first = int(rows[0])
        local = rows - first
        words = np.bincount(local)
        m = words.size
        variety[first : first + m] = distinct_share(hashes, local, m, words)
        same = local[1:] == local[:-1]
        pairs = (hashes[:-1] * np.uint64(3) + hashes[1:])[same]
        echo[first : first + m] = distinct_share(pairs, local[1:][same], m, words - 1)

    for run in runs(column):
        counts, hashes, piece = run_tallies(run)
        tallies[run.rows] += counts
        held.append((hashes, run.rows[piece]))
        if run.last[-1]:
            settle()
    t = dict(zip(TALLIES, tallies.T))

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))

    by_char = [share(t[k], t["chars"]) for k in ("symbols", "shouts", "stops", "capitals", "digits", "lines")]
    by_word = [share(t[k], t["words"]) for k in ("repeats", "single")]
    one = np.ones(n)
    return np.stack(
        [
            np.log1p(t["words"]),
            np.log1p(t["word_chars"] / np.maximum(t["words"], 1)),
            *by_char,
            *by_word,
            share(variety, one),
            share(echo, one),
        ],
        axis=1,
    )


def statistic_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = statistics(batch.column("text"))
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATISTICS))
        kept = [c for c in batch.schema.names if c != "text"]
        arrays = [batch.column(c) for c in kept] + [pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))]
        yield pa.RecordBatch.from_arrays(arrays, [*kept, "stats"])


def vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def moment_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's count, sums and products of each class, as one flat list per class."""
    d = len(STATISTICS)
    sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for batch in batches:
        x, labels = vectors(batch.column("stats")), batch.column("label").to_numpy()
        for k, into in sums.items():
            own = x[labels == k]
            into += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array([list(sums[0]), list(sums[1])], pa.list_(pa.float64()))], ["label", "sums"]
    )


@dataclass
class Discriminant:
    """Per class its mean, the inverse of its covariance's Cholesky factor, and log-determinant terms."""

    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray
    slope: float = 1.0
    intercept: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log-density under class 1 less that under class 0, in a scale that tames the tails."""
        log = [
            offset - 0.5 * (((x - mean) @ inverse.T) ** 2).sum(axis=1)
            for mean, inverse, offset in zip(self.means, self.inverses, self.offsets)
        ]
        return np.arcsinh(log[1] - log[0])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.intercept, -500, 500)))


def fit_discriminant(moments: dict[int, np.ndarray], shrink: float, ridge: float) -> Discriminant:
    d = len(STATISTICS)
    counts = {k: m[0] for k, m in moments.items()}
    means = {k: m[1 : 1 + d] / m[0] for k, m in moments.items()}
    covariances = {k: m[1 + d :].reshape(d, d) / m[0] - np.outer(means[k], means[k]) for k, m in moments.items()}
    pooled = sum(counts[k] * covariances[k] for k in (0, 1)) / sum(counts.values())
    # Each statistic is seen in units of its pooled spread, so that one ridge suits all.
    unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    inverses, offsets = [], []
    for k in (0, 1):
        own = (1 - shrink) * covariances[k] + shrink * pooled
        scaled = own / np.outer(unit, unit)
        scaled = (1 - ridge) * scaled + ridge * max(np.trace(scaled) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky((scaled + scaled.T) / 2)
        inverses.append(np.linalg.inv(factor) / unit)
        offsets.append(-np.log(np.diag(factor)).sum())
    return Discriminant(np.stack([means[0], means[1]]), np.stack(inverses), np.array(offsets))


def calibrated(model: Discriminant, bins: list[tuple[float, int, int]]) -> Discriminant:
    """Slope and intercept of the logistic curve through (difference, label, rows), slightly regularised.

    The loss is convex, and a Newton step is halved until it lowers the loss, so the best curve is found wherever
    the classes lie; whole steps run away where they are far apart.
    """
    x, y, w = (np.array(c, float) for c in zip(*bins))
    design, start = np.stack([x, np.ones(x.size)], axis=1), np.array([1.0, 0.0])

    def loss(beta: np.ndarray) -> float:
        z = design @ beta
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + 0.5e-3 * ((beta - start) ** 2).sum())

    beta, here = start, loss(start)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        gradient = design.T @ (w * (p - y)) + 1e-3 * (beta - start)
        curve = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        if gradient @ step <= 1e-10 * (1 + abs(here)):
            break
        size = 1.0
        while size > 1e-12 and loss(beta - size * step) > here - 1e-4 * size * (gradient @ step):
            size /= 2
        beta = beta - size * step
        here = loss(beta)
    model.slope, model.intercept = max(float(beta[0]), 1e-3), float(beta[1])
    return model


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``stats`` in place of the text."""
    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*others, "stats array<double>"])
    return docs.withColumnRenamed(text, "text").mapInArrow(statistic_batches, schema)


def fit_quality(stats: DataFrame, labels: DataFrame, training: Column, shrink: float = 0.1, ridge: float = 0.02):
    """The model from ``stats`` (doc_id, stats) and ``labels`` (doc_id, quality), or a constant score."""
    known = labels.where(training & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").alias("_labelled"), F.col("quality").cast("int").alias("label")
    )
    rows = materialize(
        stats.select("doc_id", "stats").join(known, F.col("doc_id") == F.col("_labelled")).select("label", "stats"),
        "quality-training",
    )
    partial = rows.mapInArrow(moment_batches, "label int, sums array<double>")
    flat = partial.select("label", F.posexplode("sums").alias("i", "x")).groupBy("label", "i").agg(F.sum("x").alias("x"))
    d = len(STATISTICS)
    moments = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for r in flat.collect():  # a fixed number of sums
        moments[r["label"]][r["i"]] = r["x"]
    if not (moments[0][0] and moments[1][0]):
        return float((moments[1][0] + 1) / (moments[0][0] + moments[1][0] + 2))
    model = fit_discriminant(moments, shrink, ridge)

    def bin_batches(batches):
        for batch in batches:
            at = np.round(model.difference(vectors(batch.column("stats"))) * 64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], ["bin", "label"])

    binned = rows.mapInArrow(bin_batches, "bin bigint, label int").groupBy("bin", "label").count()
    return calibrated(model, [(r["bin"] / 64, r["label"], r["count"]) for r in binned.collect()])


def score_statistics(stats: DataFrame, model) -> DataFrame:
    """``stats`` with ``score`` and ``predicted`` in place of the vector."""
    others = [f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields if f.name != "stats"]

    def batches_scored(batches):
        for batch in batches:
            x = vectors(batch.column("stats"))
            score = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            kept = [c for c in batch.schema.names if c != "stats"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score)], [*kept, "score"])

    scored = stats.mapInArrow(batches_scored, ", ".join([*others, "score double"]))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_quality(docs: DataFrame, labels: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1) and ``predicted``; ``training`` is over labels' doc_id."""
    clash = {"stats", "score", "predicted", "text"} & (set(docs.columns) - {text})
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    stats = materialize(text_statistics(docs, text), "quality-statistics")
    return score_statistics(stats, fit_quality(stats, labels, training))


def keep_good(docs: DataFrame, labels: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted 1, unchanged."""
    stats = text_statistics(docs.select("doc_id", text), text)
    model = fit_quality(stats, labels, training)

    def good_batches(batches):
        for batch in batches:
            if isinstance(model, float):
                keep = np.full(batch.num_rows, model >= THRESHOLD)
            else:
                keep = model.score(statistics(batch.column(text))) >= THRESHOLD
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(good_batches, docs.schema)
