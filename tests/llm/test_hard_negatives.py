import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratawell.llm import hard_negatives, queries
from tests.llm.cases import DATA, table

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=5, least=80, most=100, scale=256):
    """All results of (id, vector, label), comparing all with all."""
    whole = [
        (i, one, label, [math.floor(scale * x) for x in vector])
        for i, (one, vector, label) in enumerate(rows)
        if one is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for i, one, label, anchor in whole:
        if one % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(anchor, vector)), other, j, theirs)
            for j, other, theirs, vector in whole
            if j != i and len(vector) == len(anchor)
        ]
        scored.sort()
        for turned, other, _, _ in [s for s in scored if s[3] == label][:positives]:
            good = [s for s in scored if s[3] != label and least * -turned <= 100 * -s[0] <= most * -turned]
            out += [(one, other, r, s[1], -turned, -s[0]) for r, s in enumerate(good[:negatives], 1)]
    return sorted(out)


def mined(docs, every=100, **more):
    got = hard_negatives.hard_negatives(docs, F.col("vec_id") % every == 0, F.col("label"), **more)
    return sorted(map(tuple, got.collect()))


def test_query_against_brute_force(spark):
    rows = table(spark, "embeddings").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in rows]
    got = sorted(map(tuple, queries.op13_hard_negatives(spark, DATA).collect()))
    assert got == brute(rows) and got


@pytest.mark.parametrize(("bucket", "focus", "growth"), [(9, 2, 2), (30, 1, 8), (4096, 4, 8)])
def test_buckets_rounds_and_ties(spark, monkeypatch, bucket, focus, growth):
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    monkeypatch.setattr(hard_negatives, "FOCUS", focus)
    monkeypatch.setattr(hard_negatives, "GROWTH", growth)
    rng = np.random.default_rng(bucket)
    vectors = [[float(x) for x in rng.integers(-3, 4, 3) * rng.choice([1, 1, 5])] for _ in range(240)]
    vectors[60:120] = [vectors[0]] * 60  # one vector in a quarter of the rows
    rows = [(i, v, int(rng.integers(0, 3))) for i, v in enumerate(vectors)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert mined(docs, 20) == brute(rows, 20)
    assert mined(docs, 20, least=90, most=100, positives=3, negatives=2) == brute(rows, 20, 3, 2, 90)


def test_lengths_and_lists_prune(spark, monkeypatch):
    """Clustered vectors of very different lengths: few rows are compared, none is missed."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 16))
    rows = []
    for i in range(2000):
        v = centres[i % 12] * 0.2 + rng.standard_normal(16) * 0.01
        v = v / np.linalg.norm(v) * (4.0 if i % 10 == 0 else 0.5)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2 + 2 * (i % 12 // 6)))
    monkeypatch.setattr(hard_negatives, "BUCKET", 100)
    assert mined(spark.createDataFrame(rows, SCHEMA), 100) == brute(rows)

    vectors = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows], dtype=np.int64)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    order = np.argsort(hard_negatives._units(vectors, lengths), axis=0).T.astype(np.int32)
    ids = np.arange(len(rows))
    cells = {"ids": ids, "keys": ids, "labels": ids, "vectors": vectors, "lists": np.ascontiguousarray(order)}
    bucket = hard_negatives.Bucket(
        {"bucket": 0, "size": 16, "longest": lengths.max(), **{k: v.tobytes() for k, v in cells.items()}}
    )
    products = vectors @ vectors[0]
    floor = int(np.sort(products)[-5])
    some = bucket.candidates(vectors[0], floor)
    assert set(np.flatnonzero(products >= floor)) <= set(some.tolist()) and len(some) < 300
    assert len(bucket.candidates(vectors[1], int(lengths[1] * lengths.max() * 1.1))) == 0


def test_hard_rows(spark):
    v = [0.5, -1.25, 3.0]
    rows = [
        (0, None, 1), (0, [1.0, None, 2.0], 1), (0, [float("nan")] * 3, 1), (100, [float("-inf"), 1.0, 1.0], 1),
        (None, v, 1), (200, v, None), (200, v, 1), (200, v, 1), (5, v, 1), (5, v, 2), (5, v, 2), (6, [0.0] * 3, 1),
        (300, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (8, [0.9, 2.0], 2), (400, [], 1), (9, [], 1), (10, [], 2),
        (500, [0.0] * 3, 3), (11, [1.0, 1.0, 1.0], 3), (600, [4.0] * 5, 1), (-100, [0.45, -1.2, 2.9], 2), (12, v, 3),
        (700, [1e6, 1e6, 1e6, 1.0], 1), (13, [1e6, 1e6, 1e6, 2.0], 1), (14, [1e6, 1e6, 1e6, 1.5], 2),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "key", "vector", "size", "anchor", "bucket", "mark", "bands", "asks", "score", "rank"):
        docs = docs.withColumn(name, F.lit(1))
    got = mined(docs)
    assert got == brute(rows) and len(got) > 10


def test_too_large_and_no_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    none = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 2)], SCHEMA)
    assert mined(none) == []  # no anchor
    large = spark.createDataFrame([(0, [1e10, 1e10], 1), (1, [1e10, 1e10], 1)], SCHEMA)
    with pytest.raises(ValueError, match="bigint"):
        mined(large)
