"""Toxic spans by a linear-chain conditional random field.

Labels come per document, so tokens are labelled first: a word or the beginning
of a word that occurs in toxic documents far more often than in clean ones, by
the G-test, marks the tokens of toxic documents that carry it. Its toxic
occurrences count once per preceding word, since copies of a document repeat
all its words and prove nothing. The field
learns from a window around every such token of a document; one without any
adds one window of its first words, which holds what any other place of it
would: no sign, ordinary throughout. Its features are words and beginnings of
words; its two states are ordinary and toxic.

Forward and backward passes over a whole text, with the two states as one
ratio, give each token's probability of being toxic. Tokens of `NOTED` or more
combine to the document's score as one minus the product of their complements;
those of `SPAN` or more are reported with their offsets in code points.

Fitting takes at most `MOST_DOCS` labelled documents, picked by hash. Evidence
is counted in tasks, at most `MOST_SIGNS` signs come to the driver. Equal
windows are counted in tasks, too: each different one comes to the driver once
with its number. A null text counts as empty and scores 0; without labels
nothing is toxic.
"""

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import whole_text

MOST_DOCS, MOST_SIGNS, WINDOW = 8000, 20_000, 8
EVIDENCE, PREFIXES = 24.0, (4, 5, 6)
NOTED, SPAN, THRESHOLD = 0.1, 0.5, 0.3
REMEMBERED, GROUP_TOKENS = 500_000, 1_000_000
WINDOWS = "features array<array<int>>, tags array<int>, n long"
_WORD = re.compile(r"\w+")


def signs(word: str) -> list[str]:
    """The features of a token: the word, and its beginnings."""
    word = word.lower()
    return [word, *(word[:k] + "-" for k in PREFIXES if len(word) > k)]


@dataclass
class Field:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -30.0
    # log potentials relative to ordinary -> ordinary
    enter: float = 0.0
    leave: float = 0.0
    stay: float = 0.0


class _Scores(dict):
    """Word -> log odds that its features give, for the words of a worker."""

    def __init__(self, model: Field):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        get = self.model.weights.get
        value = self[word] = self.model.bias + sum(get(s, 0.0) for s in signs(word))
        return value


def _by_step(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chains laid out one after another, longest first: the order by step, and each step's chain count."""
    starts = np.cumsum(sizes) - sizes
    step = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    return np.argsort(step, kind="stable"), np.bincount(step, minlength=int(sizes[0]) if len(sizes) else 0)


def marginals(odds: np.ndarray, sizes: np.ndarray, model: Field) -> np.ndarray:
    """P(toxic) of every token of chains that lie one after another, longest first."""
    if not len(odds):
        return odds
    order, width = _by_step(sizes)
    local = np.exp(np.clip(odds, -60, 60))[order]
    enter, leave, stay = np.exp(model.enter), np.exp(model.leave), np.exp(model.stay)
    ahead, behind = np.empty_like(local), np.ones_like(local)
    at = np.cumsum(width) - width
    ahead[:width[0]] = local[:width[0]]
    for t in range(1, len(width)):  # the ratio of toxic to ordinary, left to right
        r = ahead[at[t - 1]:at[t - 1] + width[t]]
        ahead[at[t]:at[t] + width[t]] = local[at[t]:at[t] + width[t]] * ((enter + r * stay) / (1 + r * leave))
    for t in range(len(width) - 2, -1, -1):  # and right to left
        n = width[t + 1]
        x = local[at[t + 1]:at[t + 1] + n] * behind[at[t + 1]:at[t + 1] + n]
        behind[at[t]:at[t] + n] = (leave + stay * x) / (1 + enter * x)
    both = np.empty_like(local)
    both[order] = ahead * behind
    return both / (1 + both)


def fit(windows: list[tuple[list[list[int]], list[int], int]], names: list[str], steps: int = 120) -> Field:
    """Maximise the likelihood of labelled windows, each so many times, with Adam; gradients from exact marginals."""
    windows = sorted(windows, key=lambda w: -len(w[0]))
    sizes = np.array([len(w[0]) for w in windows], np.int64)
    total = int(sizes.sum())
    truth = np.array([y for _, ys, _ in windows for y in ys], np.float64)
    times = np.repeat(np.array([n for *_, n in windows], np.float64), sizes)
    token = np.repeat(np.arange(total), [len(f) for fs, *_ in windows for f in fs])
    feature = np.array([k for fs, *_ in windows for f in fs for k in f], np.int64)
    first = np.zeros(total, bool)
    first[np.cumsum(sizes) - sizes] = True
    inner = np.flatnonzero(~first)

    def mean(values: np.ndarray) -> float:
        """Over the pairs of neighbours."""
        return float(values @ times[inner] / times[inner].sum()) if len(inner) else 0.0

    seen = {"enter": mean((truth[inner - 1] == 0) * truth[inner]), "leave": mean(truth[inner - 1] * (truth[inner] == 0)),
            "stay": mean(truth[inner - 1] * truth[inner])}
    weights, rest = np.zeros(len(names)), np.array([-2.0, 0.0, 0.0, 0.0])
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, rest)]
    for step in range(1, steps + 1):
        model = Field({}, *rest.tolist())
        odds = model.bias + np.bincount(token, weights[feature], total)
        p = marginals(odds, sizes, model)
        # the probability of two neighbours follows from the chain cut between them
        ahead = _left(odds, sizes, model)
        behind_x = np.exp(np.clip(odds, -60, 60)) * _right(odds, sizes, model)
        r, x = ahead[inner - 1], behind_x[inner]
        enter, leave, stay = np.exp(rest[1:])
        z = 1 + enter * x + leave * r + stay * r * x
        gap = (truth - p) * times / times.sum()
        grads = [np.bincount(feature, gap[token], len(names)) * 50 - 2e-3 * weights,
                 np.array([gap.sum() * 50, (seen["enter"] - mean(enter * x / z)) * 50,
                           (seen["leave"] - mean(leave * r / z)) * 50, (seen["stay"] - mean(stay * r * x / z)) * 50])
                 - 1e-3 * np.array([0, *rest[1:]])]
        for part, grad, m in zip((weights, rest), grads, moments):
            m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.99 * m[1] + 0.01 * grad ** 2
            part += 0.1 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-8)
    return Field({n: float(w) for n, w in zip(names, weights) if abs(w) > 1e-3}, *rest.tolist())


def _left(odds: np.ndarray, sizes: np.ndarray, model: Field) -> np.ndarray:
    order, width = _by_step(sizes)
    local, out = np.exp(np.clip(odds, -60, 60))[order], np.empty_like(odds)
    enter, leave, stay = np.exp(model.enter), np.exp(model.leave), np.exp(model.stay)
    at, ahead = np.cumsum(width) - width, np.empty_like(odds)
    ahead[:width[0]] = local[:width[0]]
    for t in range(1, len(width)):
        r = ahead[at[t - 1]:at[t - 1] + width[t]]
        ahead[at[t]:at[t] + width[t]] = local[at[t]:at[t] + width[t]] * ((enter + r * stay) / (1 + r * leave))
    out[order] = ahead
    return out


def _right(odds: np.ndarray, sizes: np.ndarray, model: Field) -> np.ndarray:
    both = marginals(odds, sizes, model)
    return both / (1 - both + 1e-300) / _left(odds, sizes, model)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def learnt_windows(batches, number: dict[str, int]):
    """The windows around all numbered signs of the texts, those of a batch that are equal in one row."""
    for batch in batches:
        out: Counter = Counter()
        for text, toxic in zip(batch["text"], batch["toxic"]):
            marked = [tuple(number[s] for s in signs(w) if s in number) for w in _WORD.findall(text)]
            spans = [(max(0, k - WINDOW), k + WINDOW + 1) for k, f in enumerate(marked) if f] or [(0, 2 * WINDOW)]
            for x, y in spans:
                fs = tuple(marked[x:y])
                if fs:
                    out[fs, tuple(int(toxic == 1 and bool(f)) for f in fs)] += 1
        yield pd.DataFrame([(list(map(list, fs)), list(ys), n) for (fs, ys), n in out.items()],
                           columns=["features", "tags", "n"])


def train(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS) -> Field:
    learnt = labels.filter(~is_held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    picked = learnt.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(most_docs)
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id").select("text", "toxic")

    def count(batches):
        found = (Counter(), Counter())
        totals = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found[int(toxic == 1)].update({s for w in set(_WORD.findall(text)) for s in signs(w)})
                totals[int(toxic == 1)] += 1
        names = list(found[0] | found[1])
        yield pd.DataFrame({"sign": ["", *names], "clean": [totals[0], *(found[0][s] for s in names)],
                            "toxic": [totals[1], *(found[1][s] for s in names)]})

    counted = rows.mapInPandas(count, "sign string, clean long, toxic long").groupBy("sign").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    all_docs = rows.agg(F.count_if(F.col("toxic") == 1), F.count("*")).first()
    n_toxic, n_clean = all_docs[0], all_docs[1] - all_docs[0]
    if not n_toxic or not n_clean:
        return Field()
    share = n_toxic / (n_toxic + n_clean)

    def evidence(a: Column, c: Column) -> Column:
        def part(n: Column, expected: Column) -> Column:
            return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

        g = 2 * (part(a, (a + c) * share) + part(c, (a + c) * (1 - share)))
        return F.when((a >= 3) & (a / n_toxic > 10 * c / n_clean), g).otherwise(0.0)

    strong = counted.filter(F.col("sign") != "").withColumn("g", evidence(F.col("toxic"), F.col("clean"))).filter(
        F.col("g") > EVIDENCE).orderBy(F.desc("g"), "sign").limit(MOST_SIGNS)
    clean = {r["sign"]: r["clean"] for r in strong.collect()}

    def places(batches):
        for batch in batches:
            out = set()
            for text in batch["text"][batch["toxic"] == 1]:
                before = ""
                for word in _WORD.findall(text):
                    out.update((s, clean[s], before) for s in signs(word) if s in clean)
                    before = word
            yield pd.DataFrame(sorted(out), columns=["sign", "clean", "before"])

    apart = rows.mapInPandas(places, "sign string, clean long, before string").groupBy("sign", "clean").agg(
        F.count_distinct("before").alias("toxic"))
    chosen = [r["sign"] for r in apart.withColumn("g", evidence(F.col("toxic"), F.col("clean"))).filter(
        F.col("g") > EVIDENCE).orderBy(F.desc("g"), "sign").collect()]
    if not chosen:
        return Field()
    number = {s: k for k, s in enumerate(chosen)}

    found = rows.mapInPandas(lambda batches: learnt_windows(batches, number), WINDOWS).groupBy("features", "tags").agg(
        F.sum("n").alias("n")).toPandas()
    pairs = sorted((([list(map(int, f)) for f in fs], list(map(int, ys)), int(n))
                    for fs, ys, n in zip(found["features"], found["tags"], found["n"])), key=repr)
    return fit(pairs, chosen)


def tag(texts: list[str], model: Field, scores: _Scores | None = None) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """(score, spans) of each text; a span is (start, end, probability)."""
    scores = scores if scores is not None else _Scores(model)
    out: list = [(0.0, [])] * len(texts)
    words = [_WORD.findall(t) for t in texts]
    order = sorted((k for k, w in enumerate(words) if w), key=lambda k: -len(words[k]))
    while order:
        lot, size = [], 0
        while order and (not lot or size + len(words[order[0]]) <= GROUP_TOKENS):
            size += len(words[order[0]])
            lot.append(order.pop(0))
        sizes = np.array([len(words[k]) for k in lot], np.int64)
        odds = np.concatenate([np.fromiter(map(scores.__getitem__, words[k]), np.float64, len(words[k])) for k in lot])
        p = marginals(odds, sizes, model)
        ends = np.cumsum(sizes)
        noted = np.where(p >= NOTED, np.log1p(-np.minimum(p, 1 - 1e-12)), 0.0)
        total = np.add.reduceat(noted, ends - sizes)
        for k, a, b, t in zip(lot, ends - sizes, ends, total):
            spans = []
            if t < 0:
                high = set(np.flatnonzero(p[a:b] >= SPAN).tolist())
                spans = [(m.start(), m.end(), float(p[a + i])) for i, m in enumerate(_WORD.finditer(texts[k])) if i in high]
            out[k] = (0.0 - float(np.expm1(t)), spans)
    return out


def tagger(model: Field):
    """A column function from text to (score, spans)."""
    @F.pandas_udf("score double, spans array<struct<start:int,end:int,probability:double>>")
    def tagged(texts: pd.Series) -> pd.DataFrame:
        scores, out = _Scores(model), []
        for k in range(0, len(texts), 4000):
            out += tag(texts.iloc[k:k + 4000].tolist(), model, scores)
        return pd.DataFrame(out, columns=["score", "spans"])

    return tagged


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and the offending spans of each document."""
    return docs.select("doc_id", tagger(train(docs, labels))(whole_text()).alias("x")).select("doc_id", "x.*")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = toxicity(docs, labels)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                        F.size("spans").cast("long").alias("n_spans"))
