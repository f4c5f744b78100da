import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratawell.llm import fill_middle, queries
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts


def brute(doc, text, unit=None, seed="1"):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = [0, *(m.end() for m in re.finditer(unit or ".", text, re.DOTALL) if m.end() > m.start())]
    n = len(ends) - 1
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    a, b = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(spark):
    rows = hard_rows() + [(30 + i, t, None, None, None) for i, t in enumerate(MARKED)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


MARKED = ["a <P> b", "<S>", "x<M>", "<P", "S> <", "<p><s><m>", "P>S>M>", "<<P", "\U0001f600" * 50, "<P <S <M " * 9]


@pytest.mark.parametrize("block", [1, 3, 4096])
@pytest.mark.parametrize("unit", [None, r"\S+\s*|\s+", r"[a-z]+", "[^\n]*\n|[^\n]+"])
def test_against_brute_force(spark, unit, block):
    docs = texts(spark)
    got = fill_middle.rearrange(docs, unit=unit, block=block)
    back = got.select("doc_id", "output", "form").withColumn("text", fill_middle.restore(F.col("output"), F.col("form")))
    plain = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((brute(*r, unit) for r in plain), key=str)
    want = sorted(((d, t or "") for d, t in plain), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == want


def test_query_against_brute_force(spark):
    want = set()
    for doc, text in real_texts(spark):
        one = brute(doc, text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (one[5], text)]
        want.add((*one[:5], *sha))
    got = set(map(tuple, queries.op12_fill_middle(spark, DATA).collect()))
    assert got == want and {r[2] for r in got} == {"plain", "psm", "spm"}


def test_parameters_and_clashing_names(spark):
    docs = hard_docs(spark).withColumn("form", F.lit("x")).withColumn("output", F.lit("x")).withColumn("h1", F.lit("x"))
    got = fill_middle.rearrange(docs, seed="7", plain_from=100, spm_below=100).collect()
    assert {r["form"] for r in got if r["output"]} == {"spm"}
    assert len(got) == len(hard_rows())


def test_no_rows_and_no_utf8(spark):
    assert fill_middle.rearrange(no_docs(spark)).collect() == []
    odd = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    got = fill_middle.rearrange(odd, plain_from=0).collect()[0]
    assert (got["n"], got["output"]) == (3, "a�b")


@limits(max_examples=300, deadline=None)
@given(st.text(max_size=60), st.integers(1, 9), st.sampled_from([None, r"\w+", r"\W"]))
def test_cuts(text, block, unit):
    try:
        data = text.encode()
    except UnicodeEncodeError:
        return
    pattern = re.compile(unit, re.DOTALL) if unit else None
    tree = fill_middle.BlockTree(data, pattern, block)
    ends = [0, *(m.end() for m in re.finditer(unit or ".", text, re.DOTALL))]
    assert tree.units_all == len(ends) - 1
    for k, end in enumerate(ends):
        assert tree.cut(k) == (len(text[:end].encode()), end)
