"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all text is the unlabelled side.
A small network minimises the non-negative unbiased risk
    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))
and steps back where the second part falls below zero by more than SLACK, the noise of a batch. The class prior is the
share of good labels among the labelled documents. The network never sees a bad
label; the finished margin is turned into a probability by a logistic curve of
two numbers, for which the labelled rows of both kinds are used.

Features describe how a text is written: how often each kind of character
follows each other kind, and how its words and lines repeat. They are taken
from the whole text, in tasks. The hidden layer is learnt in the driver from at
most `MOST_ROWS` labelled and as many unlabelled rows, picked by hash. The risk
that the finished network minimises is that of all documents: with the hidden
layer given, its logistic form is convex in the `HIDDEN` + 1 last weights, and
Newton steps take its slope and curvature from sums over every row, made in
tasks; only those sums come to the driver.

A null text counts as empty. Without any positive label every score is 0.5. Of
unlike labels of one document the lesser counts, once, as repeated ones do; of
documents that share a doc_id the least text is fitted. A row without doc_id
has no label; it is unlabelled text in the sums and is scored.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stored, whole_text

MOST_ROWS = 4000
PASSES, RIDGE = 12, 1e-3
HIDDEN, STEPS, BATCH, RATE, SLACK, SEED = 24, 1200, 1024, 0.01, 0.01, 7
THRESHOLD = 0.3

# Kinds of bytes: other marks, lower, upper, digit, blank, newline, beyond ASCII, then single marks.
_MARKS = ".,;:!?|*#&%$()-'\"/@=<>_"
KINDS = 7 + len(_MARKS)
N_SHAPE = 11
N_FEATURES = KINDS * KINDS + N_SHAPE


def _kind_table() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    kinds[ord("a"):ord("z") + 1], kinds[ord("A"):ord("Z") + 1], kinds[ord("0"):ord("9") + 1] = 1, 2, 3
    kinds[[9, 11, 12, 13, 32]], kinds[10], kinds[128:] = 4, 5, 6
    for k, mark in enumerate(_MARKS):
        kinds[ord(mark)] = 7 + k
    return kinds


def features(texts: list[str]) -> np.ndarray:
    table, out = _kind_table(), np.zeros((len(texts), N_FEATURES), np.float32)
    for row, text in zip(out, texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        words, lines = text.split(), text.split("\n")
        if not words:
            row[-1] = 1
            continue
        kinds = table[raw]
        pairs = np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
        row[:-N_SHAPE] = np.sqrt(pairs / len(raw))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        used = len(words)
        row[-N_SHAPE:-1] = (np.log1p(used) / 10, len(set(words)) / used, len(set(zip(words, words[1:]))) / used,
                       sizes.mean() / 10, sizes.std() / 10, sizes.max() / 100, len(set(lines)) / len(lines),
                       np.log1p(used / len(lines)) / 5, np.mean(sizes <= 1),
                           np.mean([a == b for a, b in zip(words, words[1:])] or [0]))
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    stretch: float = 1.0
    shift: float = 0.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.first + self.first_bias)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.second + self.second_bias

    def from_hidden(self, hidden: np.ndarray) -> np.ndarray:
        margin = hidden @ self.second + self.second_bias
        return 1 / (1 + np.exp(-np.clip(self.stretch * margin + self.shift, -30, 30)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.from_hidden(self.hidden(x))


def calibrate(net: Network, x: np.ndarray, good: np.ndarray) -> None:
    """Fit the curve from margin to probability by Newton steps, kept finite by a small penalty."""
    if good.all() or not good.any():
        return
    design = np.stack([net.margin(x).astype(np.float64), np.ones(len(x))], axis=1)
    weights, penalty = np.array([1.0, 0.0]), np.diag([1e-2, 1e-2])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = design.T @ (chance - good) + penalty @ (weights - [1.0, 0.0])
        bend = (design * (chance * (1 - chance))[:, None]).T @ design + penalty
        weights = weights - np.clip(np.linalg.solve(bend, slope), -2, 2)
    net.stretch, net.shift = float(weights[0]), float(weights[1])


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk with Adam; the same rows give the same network."""
    draw = np.random.default_rng(SEED)
    n = len(positive) + len(unlabelled)
    mean = (positive.sum(0, dtype=np.float64) + unlabelled.sum(0, dtype=np.float64)) / n
    square = (np.square(positive, dtype=np.float32).sum(0, dtype=np.float64) + np.square(unlabelled, dtype=np.float32).sum(0, dtype=np.float64)) / n
    scale = np.sqrt(np.maximum(square - mean ** 2, 0)) + 1e-3
    size = len(mean)
    net = Network(mean.astype(np.float32), scale.astype(np.float32),
                  (draw.normal(size=(size, HIDDEN)) / size ** 0.5).astype(np.float32), np.zeros(HIDDEN, np.float32),
                  (draw.normal(size=HIDDEN) / HIDDEN ** 0.5).astype(np.float32), 0.0)
    parts = [net.first, net.first_bias, net.second, np.zeros(1, np.float32)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parts]
    sides = [((x - net.mean) / net.scale).astype(np.float32) for x in (positive, unlabelled)]
    for step in range(1, STEPS + 1):
        p, u = (side[draw.integers(len(side), size=min(BATCH, len(side)))] for side in sides)
        x = np.concatenate([p, u])
        hidden = np.tanh(x @ parts[0] + parts[1])
        out = hidden @ parts[2] + parts[3][0]
        chance = 1 / (1 + np.exp(-np.clip(out, -30, 30)))  # of a logistic loss's slope
        is_p = np.arange(len(x)) < len(p)
        below = np.logaddexp(0, out)
        rest = below[~is_p].mean() - prior * below[is_p].mean()
        slope = np.where(is_p, prior * (chance - 1) / len(p), 0.0)
        negative = np.where(is_p, -prior * chance / len(p), chance / len(u))
        slope = (slope + negative if rest >= -SLACK else -negative).astype(np.float32)
        back = np.outer(slope, parts[2]) * (1 - hidden ** 2)
        grads = [x.T @ back + 1e-4 * parts[0], back.sum(0), hidden.T @ slope, np.array([slope.sum()])]
        for part, grad, m in zip(parts, grads, moments):
            m[0] = 0.9 * m[0] + 0.1 * grad
            m[1] = 0.999 * m[1] + 0.001 * grad ** 2
            part -= RATE * (1 - step / (STEPS + 1)) * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
    net.second_bias = float(parts[3][0])
    return net


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def _rows(docs: DataFrame, ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the documents of at most MOST_ROWS (doc_id, quality) rows, one row per doc_id."""
    @F.pandas_udf("binary")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([row.tobytes() for row in features(texts.tolist())], dtype=object)

    picked = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(ids), "doc_id").groupBy(
        "doc_id", "quality").agg(F.min("text").alias("text"))
    found = picked.select("doc_id", "quality", described("text").alias("x")).toPandas().sort_values("doc_id")
    if not len(found):
        return np.empty((0, N_FEATURES), np.float32), np.empty(0, np.int64)
    return np.frombuffer(b"".join(found["x"]), np.float32).reshape(len(found), -1), found["quality"].to_numpy()


def hidden_rows(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id and the hidden layer of each document, HIDDEN single-precision numbers, stored."""
    @F.pandas_udf("binary")
    def hidden(texts: pd.Series) -> pd.Series:
        return pd.Series([row.astype(np.float32).tobytes() for k in range(0, len(texts), 1000)
                          for row in net.hidden(features(texts.iloc[k:k + 1000].tolist()))], dtype=object)

    return stored(docs.select("doc_id", hidden(whole_text()).alias("hidden")), "quality-hidden")


def _unpacked(hidden: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(hidden), np.float32).reshape(len(hidden), -1)


def negative_sums(hidden: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over rows of log(1 + exp(margin)), of its slope and of its curvature in the last weights, and the rows."""
    design = np.column_stack([hidden, np.ones(len(hidden))]).astype(np.float64)
    margin = design @ weights
    chance = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
    bend = (design * (chance * (1 - chance))[:, None]).T @ design
    return np.concatenate([[len(design), np.logaddexp(0, margin).sum()], design.T @ chance, bend.ravel()])


def _summed(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """`negative_sums` of all rows: tasks add up their own, Spark adds those of the tasks."""
    def partial(batches):
        total = 0.0
        for batch in batches:
            total = total + negative_sums(_unpacked(batch["hidden"]), weights)
        if np.ndim(total):
            yield pd.DataFrame({"slot": np.arange(len(total), dtype=np.int32), "v": total})

    found = rows.select("hidden").mapInPandas(partial, "slot int, v double").groupBy("slot").agg(F.sum("v").alias("v"))
    out = np.zeros(2 + len(weights) + len(weights) ** 2)
    for r in found.collect():
        out[r["slot"]] = r["v"]
    return out


def refit(net: Network, positive: np.ndarray, rows: DataFrame, prior: float) -> None:
    """Minimise the risk of all rows in the last weights, kept where its second part is not below zero by SLACK.

    A step that raises the risk or leaves that region is halved; last weights
    that begin outside it are. With logistic losses R+ less the positives' part
    of R- is minus the mean margin of the positives.
    """
    size = HIDDEN + 1
    sure = np.column_stack([net.hidden(positive), np.ones(len(positive))]).astype(np.float64)
    weights = np.append(net.second, net.second_bias).astype(np.float64)
    best, lowest = None, np.inf
    for _ in range(PASSES):
        sums = _summed(rows, weights)
        mean = sums[1:] / max(sums[0], 1.0)
        rest = mean[0] - prior * np.logaddexp(0, sure @ weights).mean()
        risk = mean[0] - prior * (sure @ weights).mean() + RIDGE / 2 * weights @ weights
        if rest < -SLACK or risk > lowest + 1e-12:
            weights = weights / 2 if best is None else (best + weights) / 2
            continue
        last, best, lowest = lowest, weights, risk
        slope = mean[1:1 + size] - prior * sure.mean(0) + RIDGE * weights
        bend = mean[1 + size:].reshape(size, size) + RIDGE * np.eye(size)
        step = np.linalg.solve(bend, slope)
        if last - lowest < 1e-6 or np.abs(step).max() < 1e-4:
            break
        weights = weights - step * min(1.0, 4.0 / np.linalg.norm(step))
    if best is not None:
        net.second, net.second_bias = best[:-1].astype(np.float32), float(best[-1])


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[Network | None, DataFrame | None]:
    """The network and the hidden layer of all rows.

    Fitted on positives whose label may be learnt and on text without regard to labels; none without such positives.
    """
    learnt = labels.filter(~is_held_out(F.col("doc_id")) & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    prior = learnt.agg(F.avg("quality")).first()[0]

    def picked(ids: DataFrame) -> DataFrame:
        return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)

    x, good = _rows(docs, picked(learnt))
    unlabelled, _ = _rows(docs, picked(docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct().withColumn(
        "quality", F.lit(0))))
    good = good == 1
    if not good.any() or not len(unlabelled):
        return None, None
    prior = min(max(prior, 0.01), 0.99)
    net = fit(x[good], unlabelled, prior)
    rows = hidden_rows(docs, net)
    refit(net, x[good], rows, prior)
    calibrate(net, x, good)
    return net, rows


def scorer(net: Network | None):
    """A column function from text to score."""
    if net is None:
        return lambda text: F.lit(0.5)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [net.probability(features(texts.iloc[k:k + 1000].tolist())) for k in range(0, len(texts), 1000)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    net, rows = train(docs, labels)

    @F.pandas_udf("double")
    def score(hidden: pd.Series) -> pd.Series:
        return pd.Series(net.from_hidden(_unpacked(hidden)) if len(hidden) else [], dtype="float64")

    scored = docs.select("doc_id", F.lit(0.5).alias("score")) if net is None else rows.select(
        "doc_id", score("hidden").alias("score"))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, all columns."""
    net, _ = train(docs, labels)
    return docs.withColumn("_llm_score", scorer(net)(whole_text())).filter(
        F.col("_llm_score") >= THRESHOLD).select(*docs.columns)
