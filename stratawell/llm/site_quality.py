"""Quality and toxicity of documents from their text and from the sites they come from.

A linear classifier on hashed words gives the evidence of each text.  Its mean over all documents
of a host, and of a path on it, shrinks towards the host and towards all documents by empirical
Bayes: the fewer documents a site has, the more.  A document's odds are those of its path, moved by
the evidence of its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.llm.common import Steps

#: Labelled documents that the classifier is fitted on: those with the smallest hashes of ids.
SAMPLE = 12_000
BUCKETS = 1 << 17
LEAST_TEXTS = 4
LEAST_DEVIATION = 4.0
EPOCHS = 10
LEARNING_RATE = 0.3
PENALTY = 1e-3
#: Prior documents that a site is worth at least and at most.
LEAST_PRIOR, MOST_PRIOR = 1.0, 1e6
#: Evidence counts no more than this, in log odds.
MOST_EVIDENCE = 8.0

_PARTS = re.compile(r"[^\W_]+|[^\w\s]+|_+").findall


def features(text: str | None) -> np.ndarray:
    """The buckets of the words and signs of a text, each once, and of how it is written."""
    parts = _PARTS(text.lower()) if text else []
    signs = sum(not part[0].isalnum() for part in parts)
    again = sum(map(str.__eq__, parts, parts[1:]))
    lines = text.split("\n") if text else [""]
    known = dict.fromkeys(parts)
    for name, count, whole in (
        ("signs", signs, len(parts)),
        ("again", again, len(parts)),
        ("lines", len(lines) - len(set(lines)), len(lines)),
        ("words", len(known), len(parts)),
    ):
        known[f" {name} {int(count / max(whole, 1) * 20)}"] = None
    hashed = pd.util.hash_array(np.array(list(known), dtype=object), categorize=False)
    return np.unique((hashed % BUCKETS).astype(np.int64))


@dataclass(frozen=True)
class Linear:
    """Log odds: a bias and the weights of the features."""

    weights: np.ndarray
    bias: float

    def log_odds(self, found: np.ndarray) -> float:
        return float(self.bias + self.weights[found].sum())


def _fit(samples: list[np.ndarray], target: np.ndarray) -> Linear:
    """Logistic regression by stochastic gradients with a rate for each weight.

    Features that go with the target no more than chance makes them have no weight: the share of
    the target among their texts is within ``LEAST_DEVIATION`` standard deviations of its mean.
    """
    n = np.bincount(np.concatenate(samples), minlength=BUCKETS)
    ones = [found for found, one in zip(samples, target) if one]
    hits = np.bincount(np.concatenate(ones or [np.empty(0, dtype=np.int64)]), minlength=BUCKETS)
    mean = target.mean()
    chance = np.sqrt(np.maximum(n * mean * (1 - mean), 1e-9))
    telling = (n >= LEAST_TEXTS) & (np.abs(hits - n * mean) > LEAST_DEVIATION * chance)
    samples = [found[telling[found]] for found in samples]
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    rate = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    bias, bias_seen = float(np.log(rate / (1 - rate))), 1e-8
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            found = samples[i]
            odds = bias + weights[found].sum()
            error = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - target[i]
            slope = error + PENALTY * weights[found]
            seen[found] += slope * slope
            weights[found] -= LEARNING_RATE * slope / np.sqrt(seen[found])
            bias_seen += error * error
            bias -= LEARNING_RATE * error / np.sqrt(bias_seen)
    return Linear(weights.astype(np.float32), bias)


def fit_text(labelled: DataFrame, text_col: str, target_cols: list[str], order: Column) -> dict[str, Linear]:
    """A classifier for each 0/1 target, fitted in one task on at most ``SAMPLE`` labelled texts.

    Rows with a NULL target do not count for it.  Without rows, every text has even odds.
    """
    steps = Steps(labelled.sparkSession)
    sample = steps.save(
        labelled.select(order.alias("place"), F.col(text_col).alias("text"), *target_cols)
        .orderBy("place", "text")
        .limit(SAMPLE)
        .drop("place")
    )

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        samples, targets = [], []
        for rows in batches:
            samples += [features(text) for text in rows["text"]]
            targets.append(rows[target_cols].to_numpy(dtype=float))
        if not samples:
            return
        values = np.concatenate(targets)
        for i, name in enumerate(target_cols):
            there = np.flatnonzero(~np.isnan(values[:, i]))
            if len(there):
                model = _fit([samples[j] for j in there], values[there, i])
                yield pd.DataFrame(
                    {"target": [name], "bias": [model.bias], "weights": [model.weights.tobytes()]}
                )

    found = sample.coalesce(1).mapInPandas(train, "target string, bias double, weights binary")
    models = {name: Linear(np.zeros(BUCKETS, dtype=np.float32), 0.0) for name in target_cols}
    for row in found.collect():
        models[row["target"]] = Linear(np.frombuffer(row["weights"], dtype=np.float32), row["bias"])
    return models


def _evidence(docs: DataFrame, text_col: str, models: dict[str, Linear]) -> DataFrame:
    """All columns and, for each target, the log odds of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # targets * BUCKETS weights
    names, text_at = list(models), docs.columns.index(text_col)
    kept = [c for c in docs.columns if c != text_col]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [features(text.as_py()) for text in batch.column(text_at)]
            columns = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            odds = [
                pa.array([shared.value[name].log_odds(x) for x in found], pa.float64())
                for name in names
            ]
            yield pa.RecordBatch.from_arrays([*columns, *odds], names=[*kept, *names])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(batches, f"{schema}, " + ", ".join(f"`{name}` double" for name in names))


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(held / (1 - held))


def _prior_documents(groups: DataFrame, mean: Column) -> float:
    """How many documents the prior of a group is worth, by the spread of the groups' means.

    The spread beyond what chance makes in groups of their sizes is what groups differ by.
    """
    square = (F.col("k") / F.col("n") - mean) ** 2
    row = groups.agg(
        F.sum(F.col("n") * square).alias("spread"),
        F.sum(mean * (1 - mean)).alias("chance"),
        F.sum("n").alias("n"),
        F.avg(mean * (1 - mean)).alias("within"),
    ).first()
    if not row["n"] or not row["within"]:
        return MOST_PRIOR
    between = max(0.0, (row["spread"] - row["chance"]) / row["n"])
    if between <= 0:
        return MOST_PRIOR
    return min(MOST_PRIOR, max(LEAST_PRIOR, row["within"] / between - 1))


def _site_odds(steps: Steps, scored: DataFrame, target: str) -> tuple[DataFrame, float]:
    """(host, path, odds): the posterior log odds of each path, and the mean of all documents."""
    p = _probability(F.col(target))
    paths = steps.save(
        scored.groupBy("host", "path").agg(F.sum(p).alias("k"), F.count(F.lit(1)).alias("n"))
    )
    total = paths.agg(F.sum("k"), F.sum("n")).first()
    mean = total[0] / total[1] if total[1] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    worth = _prior_documents(hosts, F.lit(mean))
    host = steps.save(
        hosts.select(
            F.col("host").alias("of"), ((F.col("k") + worth * mean) / (F.col("n") + worth)).alias("prior")
        )
    )
    within = steps.save(paths.join(host, F.col("host").eqNullSafe(F.col("of"))).drop("of"))
    worth = _prior_documents(within, F.col("prior"))
    posterior = (F.col("k") + worth * F.col("prior")) / (F.col("n") + worth)
    odds = steps.save(within.select("host", "path", _logit(posterior).alias("odds")))
    return odds, mean


def site_quality(
    docs: DataFrame,
    models: dict[str, Linear],
    host: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, host, path) and, for each target, its probability from text and site.

    A NULL or empty text has the evidence of its lack of words.  NULL hosts, and NULL paths of a
    host, are sites like any other.  Repeated rows count each; no rows give no rows.
    """
    steps = Steps(docs.sparkSession)
    plain = docs.select(
        F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(text_col).alias("text")
    )
    scored = steps.save(_evidence(plain, "text", models))
    result = scored
    for target in models:
        odds, mean = _site_odds(steps, scored, target)
        odds = odds.select(
            F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("odds").alias("_odds")
        )
        prior = float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6)))
        evidence = F.greatest(
            F.least(F.col(target) - prior, F.lit(MOST_EVIDENCE)), F.lit(-MOST_EVIDENCE)
        )
        result = (
            result.join(
                odds,
                F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")),
            )
            .withColumn(target, _probability(F.col("_odds") + evidence))
            .drop("_host", "_path", "_odds")
        )
    return result.withColumnRenamed("id", id_col)
