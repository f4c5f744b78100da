import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratawell.llm import queries, substrings
from stratawell.llm.common import Steps
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts


def split(text):
    for space in "\t\n\x0b\x0c\r":
        text = (text or "").replace(space, " ")
    return [w for w in text.split(" ") if w]


def brute(texts, window):
    """(n_words, n_removed, kept) of each text."""
    words = [split(t) for t in texts]
    seen = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def test_query_against_brute_force(spark):
    rows = real_texts(spark)
    want = {
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for (i, _), (n, gone, kept) in zip(rows, brute([t for _, t in rows], 35))
    }
    assert any(row[2] for row in want)
    assert set(map(tuple, queries.op7_repeated_passages(spark, DATA).collect())) == want


def test_hard_rows(spark):
    docs = hard_docs(spark)
    got = substrings.drop_repeated(docs)
    assert got.columns == [*docs.columns, "removal"]
    rows = got.select("doc_id", "removal.*").collect()
    texts = [r[1] for r in hard_rows()]
    want = [(r[0], *x) for r, x in zip(hard_rows(), brute(texts, 35))]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("window", "buffer"), [(1, 64), (5, 1), (9, 200), (16, 50), (35, 1), (40, 1 << 20)])
def test_random_texts(spark, window, buffer):
    """Windows of any length, whatever a task resolves by itself."""
    rng = random.Random(window)
    shared = [[f"s{rng.randrange(4)}" for _ in range(rng.randrange(3, 90))] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(shared)[rng.randrange(3) :]
            words += [f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    got = substrings.drop_repeated(docs, window=window).select("doc_id", "removal.*").collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute(texts, window)
    keyed = docs.withColumnRenamed("doc_id", "key").withColumn("key", F.col("key").cast("bigint"))
    steps = Steps(spark)
    spans = substrings.repeated_windows(steps, steps.save(keyed), window, buffer).collect()
    covered = {
        r["key"]: {i for lo, hi in r["spans"] for i in range(lo, hi + window)} for r in spans
    }
    assert [len(covered.get(i, ())) for i in range(60)] == [n for _, n, _ in brute(texts, window)]


def test_passage_in_a_third_of_all_texts(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [f"{passage} u{i}" if i % 3 == 0 else f"only {i} " * 20 for i in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(7)
    got = substrings.drop_repeated(docs).select("doc_id", "removal.*").collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute(texts, 35)


def test_stage(spark):
    docs = hard_docs(spark)
    kept = substrings.drop_repeated_passages(docs)
    assert kept.columns == docs.columns and kept.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[12]["text"] == "begin here end here" and rows[12]["n_chars"] == 19
    assert rows[2]["text"] == " \t\n " and rows[0]["text"] is None and rows[8]["text"] == ""


def test_no_rows(spark):
    assert substrings.drop_repeated(no_docs(spark)).collect() == []
    assert substrings.drop_repeated_passages(no_docs(spark)).collect() == []


def test_lengths_double():
    assert substrings.lengths(35) == [9, 18, 35]
    assert substrings.lengths(5) == [5]
    assert all(b <= 2 * a for a, b in zip(substrings.lengths(999), substrings.lengths(999)[1:]))
