import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stratawell.llm import packing, queries
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts

TOKENIZER = queries.WORD_TOKENIZER


def token_ids(text):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def pieces_of(rows, capacity=4096):
    found = Counter()
    for doc, text in rows:
        ids = token_ids(text)
        for at in range(0, len(ids), capacity):
            some = ids[at : at + capacity]
            packed = b"".join(i.to_bytes(4, "little") for i in some)
            found[doc, at // capacity, at, len(some), zlib.crc32(packed)] += 1
    return found


def check_layout(rows, capacity=4096):
    """(length, sequence, offset) fill sequences from 0 without gaps; returns their number."""
    by = defaultdict(list)
    for length, sequence, offset in rows:
        by[sequence].append((offset, length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_against_plain_tokenizing(spark):
    rows = queries.op2_best_fit_packing(spark, DATA).collect()
    assert Counter(tuple(r)[:5] for r in rows) == pieces_of(real_texts(spark))
    n = check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in rows])
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // 4096) + 1


def test_hard_rows(spark):
    got = packing.pack(hard_docs(spark), TOKENIZER).collect()
    found = Counter((r[0], r[1], r[2], r[3], zlib.crc32(r[4])) for r in got)
    assert found == pieces_of([(r[0], r[1]) for r in hard_rows()])
    check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in got])


def test_added_tokens_have_their_ids(spark, tmp_path):
    """By op2 and the pipeline, the ids are what the tokenizer gives by default."""
    texts = [
        "a b <|endoftext|> c", "x<|startoftext|>y", "<|endoftext|>", "<|ENDOFTEXT|> <|end oftext|>",
        "É<|endoftext|>\n e\u0301<|endoftext|><|endoftext|>don't", "w " * 4090 + "<|endoftext|> z " * 9,
        "nothing of it", "", None,
    ]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [320, 321, 49407, 322]
    want = Counter()
    for doc, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 4096):
            packed = b"".join(i.to_bytes(4, "little") for i in ids[at : at + 4096])
            want[doc, at // 4096, at, len(packed) // 4, zlib.crc32(packed)] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op2_best_fit_packing(spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    rows = corpus_pipeline.best_fit_packing(spark, docs, str(tmp_path)).collect()
    assert Counter((*r[:4], zlib.crc32(r[4])) for r in rows) == want


def test_no_rows(spark):
    assert packing.pack(no_docs(spark), TOKENIZER).collect() == []


def places_of(counts, capacity):
    rows = []
    for place in packing.plan_places(counts, capacity):
        for rank in range(place.first, place.end):
            nth = rank - place.first
            rows.append(
                (
                    place.length,
                    rank,
                    place.sequence + nth // place.copies,
                    place.offset + nth % place.copies * place.length,
                )
            )
    assert Counter((r[0], r[1]) for r in rows) == Counter(
        (n, i) for n, c in counts.items() for i in range(c)
    )
    return [(r[0], r[2], r[3]) for r in rows]


def best_fit_decreasing(counts, capacity):
    gaps, n = [], 0
    for length in sorted(counts.elements(), reverse=True):
        at = bisect_left(gaps, length)
        if at == len(gaps):
            n += 1
            gap = capacity
        else:
            gap = gaps.pop(at)
        insort(gaps, gap - length)
    return n


@pytest.mark.parametrize("seed", range(8))
def test_plans_are_whole_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    kinds = [
        lambda: rng.randrange(1, 101), lambda: rng.choice([100, 60, 40, 33]),
        lambda: rng.randrange(30, 71), lambda: min(100, int(rng.paretovariate(0.8))),
    ]
    draw = kinds[seed % 4]
    counts = Counter(draw() for _ in range(3000))
    n = check_layout(places_of(dict(counts), 100), 100)
    assert n <= best_fit_decreasing(counts, 100)


def test_one_length_fills_a_third(spark):
    """A length with a third of all pieces is ranked over all tasks, not in one."""
    docs = spark.range(0, 3000, 1, 7).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'a b c', repeat('x ', int(id % 50))) AS text"
    )
    got = packing.pack(docs, TOKENIZER, capacity=64).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got) == 3000
    check_layout([(r["length"], r["sequence_id"], r["offset"]) for r in got], 64)


def test_plan_of_nothing():
    assert packing.plan_places({}, 10) == []
