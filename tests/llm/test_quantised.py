import numpy as np
import pytest
from pyspark.sql import functions as F

from stratawell.llm import quantised, queries
from tests.llm.cases import DATA, table

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, least=0.93):
    """(id, links, component, kept) of each (id, vector, label)."""
    units = []
    for _, vector, label in rows:
        good = label is not None and vector and all(x is not None and np.isfinite(x) for x in vector)
        v = np.array(vector, dtype=float) if good else None
        units.append(v / np.linalg.norm(v) if good and v.any() else None)
    n = len(rows)
    group, links = list(range(n)), [0] * n

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= least:
                links[i] += 1
                links[j] += 1
                group[top(i)] = top(j)
    low = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            low[top(i)] = min(low.get(top(i), row[0]), row[0])
    out = []
    for i, row in enumerate(rows):
        component = low.get(top(i))
        out.append((row[0], links[i], component, row[0] == component if row[0] is not None else not links[i]))
    return sorted(out, key=str)


def real(spark):
    return [tuple(r) for r in table(spark, "embeddings").select("vec_id", "embedding", "label").collect()]


def test_query_against_brute_force(spark):
    got = queries.op4_vector_dedup(spark, DATA)
    assert sorted(map(tuple, got.collect()), key=str) == brute(real(spark))


def near(rng, centre, n, cosine):
    """Vectors with about this cosine to the centre."""
    noise = rng.standard_normal((n, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * centre + np.sqrt(1 - cosine**2) * noise


def planted(seed, n=60, size=64):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(3):
        for _ in range(n):
            centre = rng.standard_normal(size)
            centre /= np.linalg.norm(centre)
            rows += [(centre, label), (near(rng, centre, 1, rng.uniform(0.9, 0.999))[0], label)]
        rows += [(v, label) for v in near(rng, centre, 80, 0.98)]
        rows += [(centre, label)] * 5
    return [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [16, 512])
def test_recall_and_no_false_links(spark, monkeypatch, block):
    monkeypatch.setattr(quantised, "BLOCK", block)
    rows = planted(1)
    got = quantised.vector_groups(spark.createDataFrame(rows, SCHEMA).repartition(5))
    found = {r[0]: r[1] for r in got.collect()}
    want = {r[0]: r[1] for r in brute(rows)}
    assert all(found[i] <= want[i] for i in want)
    assert sum(found.values()) >= 0.95 * sum(want.values())


@pytest.mark.parametrize("size", [2, 3, 4, 8, 256])
def test_recall_in_few_and_in_many_dimensions(spark, size):
    """Pairs with a cosine right above the bound, and random ones, which in few dimensions are many."""
    rng = np.random.default_rng(size)
    vectors = []
    for _ in range(60):
        centre = rng.standard_normal(size)
        centre /= np.linalg.norm(centre)
        vectors += [centre, near(rng, centre, 1, rng.uniform(0.931, 0.95))[0]]
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(vectors)]
    found = {r[0]: r[1] for r in quantised.vector_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {r[0]: r[1] for r in brute(rows)}
    assert all(found[i] <= want[i] for i in want) and sum(want.values()) >= 100
    assert sum(found.values()) >= 0.95 * sum(want.values())


def test_hard_rows(spark):
    v = [float(x) for x in range(1, 65)]
    rows = [
        (0, None, 1), (1, [0.0] * 64, 1), (2, [*v[:-1], None], 1), (3, [*v[:-1], float("nan")], 1),
        (4, [*v[:-1], float("inf")], 1), (5, v, None), (6, v, 1), (7, [2 * x for x in v], 1), (8, v, 2),
        (9, v[:32], 1), (9, v[:32], 1), (None, v, 1), (10, [], 1), (11, [1e-38] * 64, 3), (12, [3e38] * 64, 3),
        (None, [-x for x in v], 7), (13, [1.0], 1), (14, [5.0], 1), (15, [1.0, 1.0], 1), (16, [1.0, 0.0], 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vector", "class", "n", "least", "code", "slot", "component", "links"):
        docs = docs.withColumn(name, F.lit(1))
    got = quantised.vector_groups(docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_no_rows(spark):
    assert quantised.vector_groups(spark.createDataFrame([], SCHEMA)).collect() == []
