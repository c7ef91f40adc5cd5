"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme-value statistics."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import more_fields, written

#: About so many labelled rows, at most, are used for training. Corpus tables never reach the driver.
TRAIN_ROWS = 40_000
#: So many tokens of the training texts are expected to mark toxic texts before anything is counted.
MARKERS = 50
#: The Dirichlet prior weighs as much as so many texts with the token frequencies of all training texts, but no more than
#: this share of the training texts: else it would outweigh the counts of a small table.
PRIOR, PRIOR_SHARE = 300.0, 0.1
#: Training texts that share the smallest hash of a 3-word shingle, by one of so many hash functions, count once.
SKETCHES = 3
#: Each training row's evidence for the final weights comes from tokens weighed on the other folds.
FOLDS = 3
#: First letters stand for unknown words if they are found in as many times more texts than any one word with them.
STEM_SPREAD = 1.5
#: What each token costs, and all that one costs that the model doesn't know; a segment breaks when it drops by its gain.
DRIFT = -0.5
#: Leading letters of a word that stand for it where the word itself is unknown.
STEMS = (6, 5, 4)
#: A segment is significant below this chance of one as high in a clean text of the same length.
SIGNIFICANT = 0.01

_words = regex.compile(r"\w+").findall


@dataclass
class Model:
    """Scores of tokens above 0, the extreme-value parameters of clean texts and the weights of the final score."""

    odds: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.0)


def tokens_of(text: str | None) -> list[str]:
    """The words of a text in lower case; a null text has none."""
    return _words(text.lower()) if text else []


def features(words: set[str]) -> Iterator[str]:
    """Each word, and with a hyphen behind, its first letters."""
    yield from words
    for n in STEMS:
        yield from {w[:n] + "-" for w in words if len(w) > n}


def maximal_segments(scores: list[tuple[int, float]], drift: float, length: int) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, last) of a sequence, in linear time.

    scores: (position, score) of the positions whose score isn't `drift`, which all others have, in order.
    A segment can't be extended or cut to score more, and none overlap. Each segment is held with the running totals
    before and behind it; a new one joins the nearest earlier one that began lower, if that one ended lower.
    """
    held: list[tuple[float, float, int, int, int]] = []  # total before, total behind, first, last, nearest earlier one that began lower
    total, at = 0.0, 0
    for i, s in scores:
        total += drift * (i - at)
        at = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        new = (before, total, i, i)
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][0] >= new[0]:
                j = held[j][4]
            if j < 0 or held[j][1] >= new[1]:
                held.append((*new, j))
                break
            new = (held[j][0], new[1], held[j][2], new[3])
            del held[j:]
    return [(b - a, i, j) for a, b, i, j, _ in held]


class Scorer:
    """A worker's copy of a model; what it knows of words is forgotten when it grows large."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def odds(self, word: str) -> float:
        """The score of a word, or of its longest known stem, or the drift."""
        own = self.model.odds
        found = own.get(word)
        for n in STEMS:
            if found is not None:
                break
            if len(word) > n:
                found = own.get(word[:n] + "-")
        return DRIFT if found is None else found

    def segments(self, text: str | None) -> tuple[int, list[tuple[float, int, int]]]:
        """(number of words, maximal segments) of a whole text."""
        words = tokens_of(text)
        known = self.known
        if len(known) > 150_000:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.odds(w)
        scores = [(i, s) for i, s in enumerate([known[w] for w in words]) if s != DRIFT]
        return len(words), maximal_segments(scores, DRIFT, len(words)) if scores else []

    def evidence(self, text: str | None) -> tuple[int, float, float, list[tuple[float, int, int]]]:
        """(words, best, sum, significant segments): -ln of the chance of the best segment, and of all significant ones.

        The number of segments that score S or more in n clean words is Poisson with mean k n exp(-lam S).
        """
        n, found = self.segments(text)
        best = total = 0.0
        kept = []
        for s, i, j in found:
            mean = self.model.k * max(n, 1) * math.exp(-min(700.0, self.model.lam * s))
            chance = -math.log(max(-math.expm1(-mean), 1e-300))
            best = max(best, chance)
            if chance >= -math.log(SIGNIFICANT):
                total += chance
                kept.append((s, i, j))
        return n, best, total, kept

    @staticmethod
    def inputs(best: float, total: float, kept: list[tuple[float, int, int]]) -> tuple[float, float, float]:
        """What the final weights are for."""
        return math.log1p(best), math.log1p(total), math.log1p(sum(s for s, _, _ in kept))

    def score(self, best: float, total: float, kept: list[tuple[float, int, int]]) -> float:
        """The calibrated chance that a text is toxic."""
        z = self.model.weights[0] + sum(w * v for w, v in zip(self.model.weights[1:], self.inputs(best, total, kept)))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def held_out(item: Column) -> Column:
    """Whether a row is kept out of training: CRC-32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(item.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, item: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(text, toxic, fold): labelled rows outside the held-out fold, equal texts once, about TRAIN_ROWS of them at most.

    An id with several labels counts as toxic if any of them says so; null labels and ids are left out. `fold`,
    from 0 to FOLDS - 1, follows a hash of the text.
    """
    own = labels.where(F.col(label).isNotNull() & F.col(item).isNotNull() & ~held_out(F.col(item)))
    own = own.groupBy(F.col(item).alias("__item")).agg(F.max(label).cast("int").alias("toxic"))
    share = min(1.0, TRAIN_ROWS / max(1, own.count()))
    own = own.where(F.pmod(F.xxhash64(F.lit("train"), "__item"), F.lit(1 << 20)) < int(share * (1 << 20)))
    found = written(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(item).alias("__item")).join(own, "__item"), "labelled")
    marks = [f"__mark{k}" for k in range(SKETCHES)]
    marked = found.select("__item", "toxic", F.xxhash64("text").alias("__hash"), "text").mapInArrow(
        _sketched, "__item long, toxic int, __hash long, " + ", ".join(f"{m} long" for m in marks)
    )
    marked = written(marked, "marked")
    first = F.struct(-F.col("toxic"), F.col("__hash"), F.col("__item"))  # a toxic text stands for its copies
    kept = marked
    for m in marks:
        kept = kept.join(marked.groupBy(m).agg(F.min(first).alias("__first")), m).where(first == F.col("__first")).drop("__first")
    fold = F.pmod("__hash", F.lit(FOLDS)).cast("int")
    return found.select("__item", "text").join(kept.select("__item", "toxic", fold.alias("fold")).dropDuplicates(["__item"]), "__item").drop("__item")


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column, a text, is replaced by SKETCHES smallest hashes of its 3-word shingles."""
    for batch in batches:
        rows = []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            words = tokens_of(text)
            shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, len(shingles))
            rows.append([int((hashes * np.uint64(2 * (k * 0x9E3779B97F4A7C15 % (1 << 63)) + 1)).min().view(np.int64)) for k in range(SKETCHES)])
        columns = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [[]] * SKETCHES)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *(f"__mark{k}" for k in range(SKETCHES))])


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, t0, c0, t1, c1, ...): in how many toxic and clean texts of each fold a token is found.

    Texts are counted, not occurrences, so that one text weighs little. Counts are summed in each task, then by token.
    """
    names = [f"{kind}{k}" for k in range(FOLDS) for kind in "tc"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counter[str]] = [Counter() for _ in names]

        def out() -> Iterator[pa.RecordBatch]:
            tokens = list(set().union(*held))
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), *(pa.array([h[w] for w in tokens], pa.int64()) for h in held)], ["token", *names])
            for h in held:
                h.clear()

        for batch in batches:
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns)):
                held[2 * fold + (not label)].update(features(set(tokens_of(text))))
                if sum(map(len, held)) > 300_000:
                    yield from out()
        if any(held):
            yield from out()

    counts = rows.select("text", "toxic", "fold").mapInArrow(count, "token string, " + ", ".join(f"{n} long" for n in names))
    return written(counts.groupBy("token").agg(*(F.sum(n).alias(n) for n in names)), "counts")


def token_scores(counts: DataFrame, folds: list[int], texts: int) -> dict[str, float]:
    """Scores of the tokens that speak for toxic texts: log-odds under a Dirichlet prior, shrunk by doubt, less the drift.

    counts: from token_counts; of them those of the given folds are used, which hold so many texts. A token found in n
    texts is a marker with a chance that follows by Bayes' rule from the prior one, MARKERS out of all tokens, and the
    evidence of its counts: the likelihood ratio at its own share of toxic texts against the common share, over n + 1,
    which is the least that the ratio can be on average over all shares. Its log-odds are weighed by that chance. Tokens
    that don't score above 0 then can't begin a segment and count as unknown. A token that marks nothing has an
    evidence of 1 on average, so chances of x and more come to MARKERS / x such tokens at most, however many there
    are: what reaches the driver is bounded by that and the true markers.
    """
    t, c = (sum((F.col(f"{kind}{k}") for k in folds), F.lit(0)) for kind in "tc")
    own = counts.select("token", t.alias("t"), c.alias("c")).where("t + c > 0")
    sums = own.agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("tokens")).first()
    n_t, n_c = max(1, sums["t"] or 0), max(1, sums["c"] or 0)
    share, seen = n_t / (n_t + n_c), F.col("t") + F.col("c")
    strength = F.lit(min(PRIOR / max(1, texts), PRIOR_SHARE)) * seen
    odds = F.log((F.col("t") + strength * share) / n_t) - F.log((F.col("c") + strength * (1 - share)) / n_c)
    gain = lambda x, p: F.when(x > 0, x * F.log(x / (seen * p))).otherwise(0.0)
    evidence = gain(F.col("t"), share) + gain(F.col("c"), 1 - share) - F.log(seen + 1)
    before = min(0.5, MARKERS / max(1, sums["tokens"]))
    chance = F.lit(1.0) / (F.lit(1.0) + F.lit((1 - before) / before) * F.exp(-evidence))
    best = own.select("token", "t", (chance * odds + DRIFT).alias("score")).where((F.col("score") > 0) & (odds > 0)).collect()
    widest: dict[str, int] = {}
    for r in best:
        if not r["token"].endswith("-"):
            for n in STEMS:
                widest[r["token"][:n] + "-"] = max(widest.get(r["token"][:n] + "-", 0), r["t"])
    return {r["token"]: r["score"] for r in best if not r["token"].endswith("-") or r["t"] >= STEM_SPREAD * max(1, widest.get(r["token"], 0))}


def _fit_extremes(n: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """(lam, k) of the law of the best segment of n clean words: by likelihood, over a grid of lam.

    A text without a positive segment (best 0) has its chance under the law, exp(-k n). Half a segment more than was
    seen keeps k above 0; without any, lam is 1.
    """
    up = best > 0
    size = np.maximum(n, 1).astype(float)
    if not len(n):
        return 1.0, 1.0
    fits = []
    for lam in np.geomspace(0.05, 5.0, 60) if up.any() else [1.0]:
        k = (up.sum() + 0.5) / (np.sum(size[up] * np.exp(-lam * best[up])) + size[~up].sum())
        fits.append((float(np.sum(np.log(lam * k) + np.log(size[up]) - lam * best[up]) - up.sum()), lam, k))
    return max(fits)[1:]


def _fit_logistic(x: np.ndarray, y: np.ndarray, usual: tuple[float, ...]) -> tuple[float, ...]:
    """Ridge logistic regression around the usual weights by Newton's method; slopes are kept from falling below 0."""
    a = np.column_stack([np.ones(len(x)), x])
    w0 = np.array(usual)
    w = w0.copy()
    penalty = np.diag([1e-3] + [1e-2] * x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - y) + penalty @ (w - w0))
        w -= step / max(1.0, np.abs(step).max())  # no step is longer than 1: far from the end Newton's overshoot
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), *np.maximum(w[1:], 0.0).tolist())


def fit(docs: DataFrame, labels: DataFrame, **names: str) -> Model:
    """A model from the labelled rows of docs outside the held-out fold.

    Tokens are weighed on all training rows; and for each fold of them on the other folds, for what follows. The best
    segments of clean texts give the extreme-value law, and by that law the evidence of all segments of each whole text
    gives the final weights; of each row (TRAIN_ROWS at most) a few numbers come to the driver for that. Both are shrunk
    towards usual values, so few rows do. Without rows of both labels the model finds nothing toxic.
    """
    rows = written(training_rows(docs, labels, **names), "training")
    counts = token_counts(rows)
    texts = {r["fold"]: r["count"] for r in rows.groupBy("fold").count().collect()}
    chosen = lambda folds: token_scores(counts, folds, sum(texts.get(k, 0) for k in folds))
    model = Model(odds=chosen([*range(FOLDS)]))
    if not model.odds:
        return model
    others = [Model(odds=chosen([j for j in range(FOLDS) if j != k])) for k in range(FOLDS)]
    told = rows.select("text", "toxic", "fold")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [*map(Scorer, others)]
        for batch in batches:
            found = [scorers[fold].segments(text) for text, fold in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            columns = [pa.array([n for n, _ in found], pa.int64()), pa.array([max([s for s, _, _ in f], default=0.0) for _, f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["n", "best"])

    clean = told.where("toxic = 0").mapInArrow(best, "n long, best double").toPandas()
    model.lam, model.k = _fit_extremes(clean["n"].to_numpy(), clean["best"].to_numpy())
    for m in others:
        m.lam, m.k = model.lam, model.k

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [*map(Scorer, others)]
        for batch in batches:
            found = [scorers[fold].evidence(text) for text, fold in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            columns = zip(*(Scorer.inputs(*f[1:]) for f in found)) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in columns), batch.column(1)], ["best", "total", "sum", "toxic"])

    seen = told.mapInArrow(evidence, "best double, total double, sum double, toxic int").toPandas()
    model.weights = _fit_logistic(seen[["best", "total", "sum"]].to_numpy(), (seen["toxic"] > 0).to_numpy(float), Model.weights)
    return model


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with score (0 to 1), predicted (1 if the score is at least 0.5) and passages; columns so named are replaced.

    passages: the significant segments of the whole text, as (first word, last word, score), in order. A null or empty
    text, or one without words, has the score of no evidence.
    """
    own = ["score", "predicted", "passages"]
    kept = docs.drop(*own)
    schema = more_fields(kept, "score double, predicted int, passages array<struct<first:int,last:int,score:double>>")
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores, passages = [], []
            for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
                _, best, total, found = scorer.evidence(t)
                scores.append(scorer.score(best, total, found))
                passages.append([{"first": i, "last": j, "score": s} for s, i, j in found])
            more = [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)
