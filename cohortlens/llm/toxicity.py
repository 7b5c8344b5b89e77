"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from .common import release_memory

#: Labelled rows the lexicon and the classifier are learned from, at most (least hashes of ids first).
MAX_LABELLED = 50_000
#: Lexicon entries, lexicon voters they are dealt to in turn, and what an entry needs: the share of toxic
#: texts among those with it, and the chance (of any entry at all) to get that far by luck.
MAX_LEXICON, LEXICON_VOTERS = 1024, 24
MIN_SHARE, LUCK = 0.9, 0.05
#: No voter is trusted to err on fewer clean texts than this share.
CLEAN_RATE = 0.01
THRESHOLD = 0.3

WORDS = re.compile(r"[^\W\d_]+")
#: Pattern voters, after the lexicon's indexes. Each takes (entries, words, capital words, exclamation marks).
PATTERNS = (
    ("no entry", lambda e, w, c, x: e == 0),
    ("two entries", lambda e, w, c, x: e >= 2),
    ("four entries", lambda e, w, c, x: e >= 4),
    ("an entry in fifty words", lambda e, w, c, x: e * 50 >= w > 0 and e > 0),
    ("shouting", lambda e, w, c, x: w >= 5 and c * 3 >= w),
    ("exclaiming", lambda e, w, c, x: x >= 3),
)


def entries(text: str) -> set[str]:
    """Lower-case words of a text, and the first four and five letters of longer ones, starred."""
    words = set(WORDS.findall(text.lower()))
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def active(text: str | None, lexicon: dict[str, int]) -> list[int]:
    """Indexes of the lexicon entries and patterns a text shows."""
    text = text if isinstance(text, str) else ""
    words = WORDS.findall(text.lower())
    own = set(words)
    found = {lexicon[w] for w in own & lexicon.keys()}
    for w in own:
        if len(w) > 4:
            i = lexicon.get(w[:4] + "*")
            if i is not None:
                found.add(i)
            if len(w) > 5:
                i = lexicon.get(w[:5] + "*")
                if i is not None:
                    found.add(i)
    capitals = sum(w.isupper() and len(w) > 1 for w in WORDS.findall(text)) if not text.islower() and "!" in text else 0
    facts = (len(found), len(words), capitals, text.count("!"))
    return sorted(found) + [len(lexicon) + i for i, (_, test) in enumerate(PATTERNS) if test(*facts)]


def held_out(id: str) -> Column:
    """Rows no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@dataclass
class Toxicity:
    """Lexicon and weights of the fitted classifier; small, so it is broadcast."""

    lexicon: dict[str, int]
    weights: np.ndarray
    bias: float
    voters: pd.DataFrame  # name, accuracy on toxic and on clean texts, weight after correlation

    def score(self, indexes: list[int]) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[indexes].sum()))))


def _labelled(docs: DataFrame, labels: DataFrame, id: str, text: str) -> DataFrame:
    """Bounded sample of learnable labels, one per distinct text and one per id: ``id, _toxic``."""
    known = labels.filter(F.col(id).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id)).groupBy(id).agg(F.max("toxic").alias("_toxic"))
    marked = docs.filter(F.col(id).isNotNull()).select(id, F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_same")).join(known, id)
    one = marked.groupBy("_same").agg(F.min(F.struct(id, "_toxic")).alias("r")).select(F.col(f"r.{id}"), "r._toxic")
    per_id = one.groupBy(id).agg(F.max("_toxic").alias("_toxic"))
    return materialise(per_id.orderBy(F.xxhash64(id), id).limit(MAX_LABELLED), "labelled")


def _lexicon(texts: DataFrame, text: str) -> tuple[dict[str, int], float]:
    """Entries that mark toxic texts, strongest first, and the toxic share."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for pdf in batches:
            for t, y in zip(pdf[text], pdf["_toxic"]):
                (toxic if y else clean).update(entries(t if isinstance(t, str) else ""))
            if len(toxic) + len(clean) > 400_000:  # hand on what was counted; Spark adds it up
                yield _counts(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield _counts(toxic, clean)

    per = texts.select(text, "_toxic").mapInPandas(count, "entry string, toxic long, clean long")
    sums = materialise(per.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "entries")
    n = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_toxic"), F.lit(0)).alias("y")).first()
    if not n.y or n.y == n.n:
        return {}, 0.0
    share = n.y / n.n
    all_ = F.col("toxic") + F.col("clean")
    f = F.col("toxic") / all_
    # Chernoff bound of drawing that many toxic texts, against the number of entries looked at
    other = F.when(f < 1, (1 - f) * F.log((1 - f) / (1 - share))).otherwise(0.0)
    strength = all_ * (f * F.log(f / share) + other)
    enough = float(np.log(max(1, sums.count()) / LUCK))
    best = sums.filter((f >= MIN_SHARE) & (strength >= enough)).orderBy(strength.desc(), "entry").limit(MAX_LEXICON).collect()
    return {r.entry: i for i, r in enumerate(best)}, share


def _counts(toxic: Counter, clean: Counter) -> pd.DataFrame:
    keys = list(toxic.keys() | clean.keys())
    return pd.DataFrame({"entry": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]}).astype(
        {"entry": str, "toxic": "int64", "clean": "int64"}
    )


def voters_of(size: int) -> np.ndarray:
    """Voter of each lexicon entry (dealt in turn, so each voter has words of all kinds) and pattern."""
    n = min(LEXICON_VOTERS, size)
    return np.concatenate([np.arange(size) % max(1, n), n + np.arange(len(PATTERNS))]).astype(int)


def _moments(shown: DataFrame, voter: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of texts and second moments of the votes over all of them, added up by Spark."""
    k = int(voter.max()) + 1

    def add(batches):
        total, n = np.zeros((k, k)), 0
        for pdf in batches:
            votes = np.zeros((len(pdf), k))
            for r, idx in enumerate(pdf["active"]):
                votes[r, voter[idx]] = 1
            total += votes.T @ votes
            n += len(pdf)
        i, j = np.divmod(np.arange(k * k), k)
        yield pd.DataFrame({"i": [*i, -1], "j": [*j, -1], "s": [*total.ravel(), float(n)]})

    rows = shown.select("active").mapInPandas(add, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    out = np.zeros((k, k))
    for i, j, s in rows.itertuples(index=False):
        if i >= 0:
            out[int(i), int(j)] = s
    return int(rows.s[rows.i < 0].sum()), out


def label_model(n: int, moments: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vote rates on toxic and clean texts, and weights that allow for correlated voters.

    With votes independent given the label, the covariance of two voters is share (1 - share)
    times the product of their rate differences. That rank-one part is fitted to the pairs off
    the diagonal; pairs with a correlation left over are taken as dependent, and refitted
    without. A voter's evidence is divided by one plus its left-over correlations.
    """
    mean = np.diag(moments) / n
    cov = moments / n - np.outer(mean, mean)
    q = max(share * (1 - share), 1e-6)
    fit, diff = cov.copy(), np.sqrt(np.maximum(np.diag(cov), 0) / q) * 0.5
    free = np.eye(len(mean), dtype=bool)
    rho = np.zeros_like(cov)
    for _ in range(30):
        fit = np.where(free, q * np.outer(diff, diff), cov)
        values, vectors = np.linalg.eigh(fit)
        lead = vectors[:, -1] * np.sqrt(max(values[-1], 0) / q)
        diff = lead if lead.sum() >= 0 else -lead
        toxic = np.clip(mean + (1 - share) * diff, 1e-4, 1 - 1e-4)
        clean = np.clip(mean - share * diff, CLEAN_RATE, 1 - 1e-4)
        spread = np.sqrt(share * toxic * (1 - toxic) + (1 - share) * clean * (1 - clean))
        rho = (cov - q * np.outer(diff, diff)) / np.outer(spread, spread)
        np.fill_diagonal(rho, 0)
        free = np.eye(len(mean), dtype=bool) | (np.abs(rho) > 0.3)
    return toxic, clean, 1 / (1 + np.clip(rho, 0, 1).sum(axis=1))


def _logistic(rows: list[list[int]], target: np.ndarray, size: int, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights of a penalised logistic regression on soft labels; rows are index lists."""
    lens = np.array([len(r) for r in rows])
    flat = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if lens.sum() else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), lens)
    w, b = np.zeros(size), float(np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6)))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, 401):
        logit = b + np.bincount(owner, w[flat], len(rows))
        gap = 1 / (1 + np.exp(-logit)) - target
        g = np.append(np.bincount(flat, gap[owner], size) + penalty * w, gap.sum()) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", active: str = "active", keep: list[str] | None = None
) -> tuple[Toxicity, DataFrame]:
    """The fitted model, and for every row of ``docs`` the columns ``keep`` (the id) and its votes in a column ``active``.

    The lexicon is learned from at most ``MAX_LABELLED`` labelled rows that are not held out, each
    distinct text once. Its entries, dealt to some voters, and the patterns vote; votes are counted over
    all texts, and the label model gives each text of the sample a posterior. The classifier is
    trained on those posteriors, over all entries and patterns. Labels of unknown ids, null labels
    and repeated labels (the largest counts) do no harm; without toxic labels scores are near 0. An id
    that many rows repeat is learned from once, by the least of its texts and of its votes.
    """
    spark = docs.sparkSession
    sample = _labelled(docs, labels.select(id, "toxic"), id, text)
    # at most MAX_LABELLED rows of two numbers; rows that repeat an id are folded before anything is learned or collected
    texts = docs.select(id, text).join(F.broadcast(sample), id).groupBy(id, "_toxic").agg(F.min(text).alias(text))
    lexicon, share = _lexicon(texts, text)
    shared = spark.sparkContext.broadcast(lexicon)
    shown = materialise(docs.select(*(keep or [id]), F.pandas_udf(active_run(shared), "array<int>")(text).alias(active)), "active")
    size, voter = len(lexicon) + len(PATTERNS), voters_of(len(lexicon))
    n, moments = _moments(shown.select(F.col(active).alias("active")), voter)
    if not lexicon or not n:
        return Toxicity(lexicon, np.zeros(size), -6.0, pd.DataFrame()), shown
    toxic, clean, trust = label_model(n, moments, share)
    evidence = trust * np.log(toxic / clean)
    prior = np.log(share / (1 - share))
    of_sample = shown.select(id, F.col(active).alias("_votes")).join(F.broadcast(sample), id).groupBy(id).agg(F.min("_votes").alias("_votes"))
    learn = [list(r._votes) for r in of_sample.orderBy(id).collect()]  # a row for each sampled id
    logit = np.array([prior + evidence[np.unique(voter[r])].sum() for r in learn])
    weights, bias = _logistic(learn, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), size)
    names = [f"lexicon {i}" for i in range(min(LEXICON_VOTERS, len(lexicon)))] + [p for p, _ in PATTERNS]
    return Toxicity(lexicon, weights, bias, pd.DataFrame({"voter": names, "on_toxic": toxic, "on_clean": clean, "trust": trust})), shown


def active_run(shared):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([active(t, shared.value) for t in texts])
        release_memory()

    return run


def score_active(shown: DataFrame, model: Toxicity, indexes: str = "active") -> Column:
    shared = shown.sparkSession.sparkContext.broadcast(model)

    def run(rows: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(list(r)) for r in rows], dtype=float)

    return F.pandas_udf(run, "double")(indexes)


def toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, held_out, score, predicted`` for every row of ``docs``, repeated rows and null ids too."""
    model, shown = fit_toxicity(docs, labels, id, text)
    scored = shown.select(F.col(id), held_out(id).alias("held_out"), score_active(shown, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose score is below the threshold, all columns kept.

    The rows are written with their votes, so that each text's votes are taken once.
    """
    votes = "_votes"
    while votes in docs.columns:
        votes += "_"
    model, shown = fit_toxicity(docs, labels, id, text, votes, docs.columns)
    return shown.filter(score_active(shown, model, votes) < THRESHOLD).select(*docs.columns)
