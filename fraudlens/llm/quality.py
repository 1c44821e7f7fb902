"""Quality classifier: a label model over overlapping heuristics trains a hashed linear scorer.

1. Every document gets the votes (junk, fine, abstain) of the heuristics in
   ``Votes``; they overlap, as several look at the same kind of junk.
2. The distinct vote patterns (at most 3 ** heuristics) are counted over all documents.
   Expectation-maximisation on these counts estimates each heuristic's accuracy for
   either class and the share of junk, and gives every pattern a posterior.
3. A logistic scorer over hashed word-shape features is fitted to the
   posteriors of a sample of ``SAMPLE`` documents at most (those with the smallest
   hash of their id), and scores every document.

The scorer reads whole texts in Arrow batches; only vote patterns and the bounded
sample reach the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from fraudlens.llm.common import staged

SAMPLE = 4000            # documents that the scorer is fitted on, at most
DIMENSIONS = 1 << 11
THRESHOLD = 0.5          # posterior of fine text at which a document is kept
JUNK, FINE, ABSTAIN = 1, 0, -1
SHAPE_ROOM = 100_000

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_SHAPES: dict[str, str] = {}


class Votes:
    """The heuristics.  Each returns the measure of a text; two bounds turn it into a vote."""

    #: name: (fine below, junk above); between the bounds the heuristic abstains
    BOUNDS = {"symbols": (0.03, 0.06), "bare_marks": (0.1, 0.25), "marked_words": (0.1, 0.3), "shouting": (0.2, 0.5),
              "repeats": (0.1, 0.25), "few_kinds": (0.7, 0.85), "line_marks": (0.02, 0.08)}

    @staticmethod
    def measures(text: str, words: list[str]) -> tuple[float, ...]:
        n, size = len(words), max(1, len(text))
        plain = len(text.translate(_SYMBOLS))
        bare = sum(1 for w in words if not any(map(str.isalnum, w)))
        marked = sum(1 for w in words if len(w) > 2 and w[-1] in _MARKS and w[-2] in _MARKS)
        # texts of a few words neither repeat nor shout by these measures alone
        shout = sum(map(str.isupper, words)) / n
        repeats = sum(map(eq, words, words[1:])) / max(1, n - 1)
        kinds = 1 - len(set(words)) / n
        return ((size - plain) / size, bare / n, marked / n, shout, repeats, kinds,
                (text.count("|") + text.count("!!")) / size)

    @classmethod
    def of(cls, text: str) -> str:
        """One character per heuristic: 1 junk, 0 fine, - abstains.  All abstain without words."""
        words = text.split()
        if not words:
            return "-" * len(cls.BOUNDS)
        out = []
        for (fine, junk), x in zip(cls.BOUNDS.values(), cls.measures(text, words)):
            out.append("1" if x > junk else "0" if x < fine else "-")
        return "".join(out)


_MARKS = frozenset("!#$%&*+/<=>@\\^_`{|}~")
_SYMBOLS = {ord(c): None for c in _MARKS}


def label_model(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Posterior of junk for each vote pattern, by expectation-maximisation.

    Starts from the share of junk votes; keeps one accuracy per heuristic, class
    and vote.  Patterns without any vote get the prior.
    """
    keys = sorted(patterns)
    if not keys:
        return {}
    n = np.array([patterns[k] for k in keys], dtype=float)
    votes = np.array([[{"1": JUNK, "0": FINE, "-": ABSTAIN}[c] for c in k] for k in keys])
    cast = votes != ABSTAIN
    post = np.where(cast.any(1), ((votes == JUNK).sum(1) > 0) * 0.9 + 0.05, 0.5)
    for _ in range(rounds):
        prior = float((n * post).sum() + 1) / (n.sum() + 2)
        logit = np.full(len(keys), math.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            for v in (JUNK, FINE):
                at = votes[:, j] == v
                if at.any():
                    p_junk = ((n * post)[at].sum() + 0.1) / ((n * post)[cast[:, j]].sum() + 0.2)
                    p_fine = ((n * (1 - post))[at].sum() + 0.1) / ((n * (1 - post))[cast[:, j]].sum() + 0.2)
                    logit[at] += math.log(p_junk / p_fine)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return dict(zip(keys, map(float, post)))


def _shape(word: str) -> str:
    got = _SHAPES.get(word)
    if got is None:
        letters = _LETTERS.sub(lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "x", word)
        got = _DIGITS.sub("0", letters)[:8]
        if len(_SHAPES) >= SHAPE_ROOM:
            _SHAPES.clear()
        _SHAPES[word] = got
    return got


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features (indices, values): shares of word shapes, shape pairs and adjacent repeats."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    shapes = list(map(_shape, words))
    n, acc = len(words), Counter()
    for s, c in Counter(shapes).items():
        acc[zlib.crc32(s.encode()) % DIMENSIONS] += c / n
    for (a, b), c in Counter(zip(shapes, shapes[1:])).items():
        acc[zlib.crc32(f"{a}\t{b}".encode()) % DIMENSIONS] += c / n
    acc[zlib.crc32(b"\tsame") % DIMENSIONS] += 4 * sum(map(eq, words, words[1:])) / n
    return np.fromiter(acc.keys(), np.int32, len(acc)), np.fromiter(acc.values(), np.float32, len(acc))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], junk: np.ndarray, steps: int = 400, rate: float = 2.0,
        l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels on sparse rows: weights and bias of the log odds of junk."""
    x = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, (at, value) in enumerate(rows):
        x[i, at] = value
    w, b, grad2 = np.zeros(DIMENSIONS, np.float32), 0.0, np.full(DIMENSIONS, 1e-4, np.float32)
    for _ in range(steps):
        err = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - junk
        g = x.T @ err / len(rows) + l2 * w
        grad2 += g * g
        w -= (rate * g / np.sqrt(grad2)).astype(np.float32)
        b -= rate * float(err.mean())
    return w, b


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
             threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs``, row by row, and ``_votes, _score, _keep``.

    ``_score`` is the probability of fine text; rows at or above ``threshold`` are kept.
    NULL, empty and white texts have no words: score 0, rejected.  Equal
    texts get equal scores, and scores do not depend on how rows are dealt to tasks.  Texts of any length are read whole.
    Of rows that repeat an id and its text one can be drawn for the sample; rows with a NULL id are drawn by their text.  With an empty table the result is empty.  Input columns
    with the names of the added ones are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("_votes", "_score", "_keep")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def vote(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([Votes.of(t.as_py()) for t in b.column(2)], pa.string())],
                                             names=["h", "t", "votes"])

    # the sample: the smallest hashes of ids and texts, so that any input gives the same share of every kind
    rows = rows.select(F.xxhash64("id", F.lit(17)).alias("h"), F.xxhash64("text").alias("t"), "text")
    voted = staged(rows.mapInArrow(vote, "h bigint, t bigint, votes string"), "votes")
    patterns = {r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior = label_model(patterns)
    # a row that repeats an id and its text is drawn once: the sample has its size whatever repeats, and one order
    last = voted.select("h", "t").distinct().orderBy("h", "t").limit(sample).agg(F.max(F.struct("h", "t"))).first()[0]

    def featurise(batches):
        for b in batches:
            got = [(Votes.of(t), *features(t)) for t in (x.as_py() for x in b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.int32())),
                 pa.array([g[2] for g in got], pa.list_(pa.float32()))], names=["h", "t", "votes", "at", "value"])

    chosen = [] if last is None else sorted(
        rows.where((F.col("h") < last["h"]) | ((F.col("h") == last["h"]) & (F.col("t") <= last["t"]))).dropDuplicates(["h", "t"])
        .mapInArrow(featurise, "h bigint, t bigint, votes string, at array<int>, value array<float>").collect(),
        key=lambda r: (r["h"], r["t"]))
    if chosen:
        w, bias = fit([(np.array(r["at"], np.int32), np.array(r["value"], np.float32)) for r in chosen],
                      np.array([posterior[r["votes"]] for r in chosen], np.float32))
    else:
        w, bias = np.zeros(DIMENSIONS, np.float32), 0.0
    weights, at_text = spark.sparkContext.broadcast((w, bias)), docs.columns.index(text_col)

    def score(batches):
        w, bias = weights.value
        for b in batches:
            votes, scores = [], []
            for t in (x.as_py() or "" for x in b.column(at_text)):
                at, value = features(t)
                odds = float(value @ w[at]) + bias
                scores.append(round(1 / (1 + math.exp(min(30.0, max(-30.0, odds)))), 6) if len(at) else 0.0)
                votes.append(Votes.of(t))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(votes, pa.string()), pa.array(scores, pa.float64()),
                 pa.array([s >= threshold for s in scores], pa.bool_())],
                names=[*b.schema.names, "_votes", "_score", "_keep"])

    schema = StructType([*docs.schema.fields, StructField("_votes", StringType()), StructField("_score", DoubleType()),
                         StructField("_keep", BooleanType())])
    return docs.mapInArrow(score, schema)
