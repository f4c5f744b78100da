import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratawell.llm import privacy, queries
from tests.llm.cases import DATA, hard_docs, no_docs, table
from tests.llm.test_packing import check_layout, pieces_of
from tests.llm.test_privacy import brute as private
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_substrings import brute as passages


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_stages_against_plain_python(spark):
    docs = table(spark, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "language_id", "simhash_dedup", "substring_dedup", "personal_data", "best_fit_packing",
    ]

    kept = stages["language_id"](spark, docs, DATA).cache()
    found = queries.op5_language_id(spark, DATA)
    assert Counter(r[0] for r in rows_of(kept)) == Counter(
        r["doc_id"] for r in found.filter("NOT rejected").collect()
    )

    rows = rows_of(kept)
    lows = brute_components([i for i, _ in rows], [brute_fingerprint(t) for _, t in rows])
    unique = stages["simhash_dedup"](spark, kept, DATA).cache()
    assert Counter(rows_of(unique)) == Counter(r for r, low in zip(rows, lows) if r[0] == low)

    rows = rows_of(unique)
    want = Counter(
        (i, kept if gone else text)
        for (i, text), (_, gone, kept) in zip(rows, passages([t for _, t in rows], 35))
    )
    cut = stages["substring_dedup"](spark, unique, DATA).cache()
    assert Counter(rows_of(cut)) == want and cut.columns == docs.columns

    masked = stages["personal_data"](spark, cut, DATA).cache()
    before = dict(rows_of(cut))
    assert masked.columns == docs.columns
    for i, text in rows_of(masked):
        hits = sum(map(len, private(before[i]).values()))
        assert (text != before[i]) == bool(hits)
        assert not any(private(text).values())

    packed = stages["best_fit_packing"](spark, masked, DATA).collect()
    got = Counter((r[0], r[1], r[2], r[3], zlib.crc32(r[4])) for r in packed)
    assert got == pieces_of(rows_of(masked))
    check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in packed])


def test_run_is_the_stages_in_turn(spark):
    docs = table(spark, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    columns = ["doc_id", "piece", "start", "length", "ids"]
    got = corpus_pipeline.run(spark, DATA).select(columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, docs.select(columns).collect()))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_hard_and_no_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, no_docs(spark), DATA).collect() == []
    docs = hard_docs(spark)
    got = stage(spark, docs, DATA)
    assert got.count() > 0
    if name != "best_fit_packing":
        assert got.columns == docs.columns


def test_clean_documents_stay(spark):
    """What is in no near copy, passage or private span comes out as it went in."""
    docs = table(spark, "documents")
    kept = {i for i, _ in rows_of(corpus_pipeline.language_id(spark, docs, DATA))}
    assert len(kept) >= 0.99 * docs.count()
    assert privacy.mask_private(docs.filter(F.length("text") < 0)).collect() == []
