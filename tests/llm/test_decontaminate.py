import re

import pytest
from pyspark.sql import functions as F

from stratawell.llm import decontaminate
from tests.llm.cases import CLASHING, hard_docs, no_docs

ITEMS = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, window=10, shingle=3, share=1.0):
    """(id, words, hit words, spans, items) by comparing every stretch with every window."""
    cut = []
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        cut += [(item, w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item, one in cut:
            k = min(shingle, len(one))
            for at in range(len(w) - len(one) + 1):
                there = w[at : at + len(one)]
                n = len(one) - k + 1
                same = sum(one[i : i + k] == there[i : i + k] for i in range(n))
                if same >= n * share - 1e-9:
                    hit |= set(range(at, at + len(one)))
                    named |= {item} - {None}
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((doc, len(w), len(hit), [tuple(s) for s in spans], sorted(named)))
    return sorted(out, key=str)


def rows(found):
    return sorted(
        ((r[0], r[1], r[2], [tuple(s) for s in r["spans"]], list(r["items"])) for r in found.collect()),
        key=str,
    )


PASSAGE = "the quick brown fox jumps over a lazy dog and then sleeps all day"
DOCS = [
    (0, f"Before. {PASSAGE.upper()}! after"), (1, f"{PASSAGE} {PASSAGE}"), (2, PASSAGE[:40]), (3, None), (4, ""),
    (5, "one two"), (6, "x one two one two y"), (7, "a a a a a a a a a a a a a a"), (8, "Ünïcode wörds ΑΣ ünïcode É é"),
    (9, "the quick brown fox JUMPS over one lazy dog and then sleeps all day"), (10, " .,- "), (None, PASSAGE),
    (None, "other"), (1, f"{PASSAGE} {PASSAGE}"), (11, "É"), (12, "a1\x00b2 c3"), (13, "w " * 3000 + PASSAGE),
]
QUERIES = [
    (1, PASSAGE), (2, "one two"), (3, None), (4, ""), (5, "a a a a a a a a a a a"), (6, "é"), (7, "b2 C3"),
    (1, PASSAGE), (8, PASSAGE.replace("fox", "cat")), (None, "x one"), (9, "ünïcode É"), (10, "never seen here at all"),
]


@pytest.mark.parametrize(
    ("window", "shingle", "share"), [(10, 3, 1.0), (10, 3, 0.5), (4, 2, 0.6), (10, 1, 0.8), (3, 5, 1.0)]
)
def test_against_brute_force(spark, window, shingle, share):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string").repartition(3)
    items = spark.createDataFrame(QUERIES, ITEMS)
    got = decontaminate.contamination(docs, items, window, shingle, share)
    assert rows(got) == brute(DOCS, QUERIES, window, shingle, share)


def test_large_benchmarks_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(QUERIES, ITEMS)
    assert rows(decontaminate.contamination(docs, items, 4, 2)) == brute(DOCS, QUERIES, 4, 2)


def test_items_that_share_a_window_with_many_copies(spark):
    docs = [(i, f"{PASSAGE} {i % 7}") for i in range(600)]
    items = [(i, f"{PASSAGE} tail{i}") for i in range(50)]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, ITEMS)
    assert rows(decontaminate.contamination(*frames)) == brute(docs, items)


def test_hard_rows_and_clashing_names(spark):
    items = spark.createDataFrame(QUERIES, ITEMS)
    for name in [*CLASHING, "window", "window_id", "n_words", "hash", "item"]:
        items = items.withColumn(name, F.lit(name))
    docs = hard_docs(spark).withColumn("window", F.lit(1)).withColumn("n_words", F.lit(1))
    plain = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert rows(decontaminate.contamination(docs, items)) == brute(plain, QUERIES)


def test_no_rows(spark):
    items = spark.createDataFrame(QUERIES, ITEMS)
    assert decontaminate.contamination(no_docs(spark), items).collect() == []
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    assert rows(decontaminate.contamination(docs, items.limit(0))) == brute(DOCS, [])


def test_text_that_is_not_utf8(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'6F6E652074776FFF' AS STRING) AS text")
    items = spark.createDataFrame([(1, "one")], ITEMS)
    assert rows(decontaminate.contamination(docs, items))[0][2] == 1
