import hashlib

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from stratawell.llm import pieces, queries
from tests.llm.cases import DATA, hard_docs, hard_rows, no_docs, real_texts

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
OWN = pieces.PieceModel(queries.PIECE_MODEL)


def own_ids(text):
    import numpy as np

    return np.frombuffer(OWN.encode(text), dtype="<i4").tolist()


def test_query_against_the_library(spark):
    want = set()
    for doc, text in real_texts(spark):
        ids = LIBRARY.encode(text)
        joined = ",".join(map(str, ids)).encode()
        decoded = LIBRARY.decode(ids).encode()
        want.add(
            (doc, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(decoded).hexdigest())
        )
    assert set(map(tuple, queries.op10_pieces(spark, DATA).collect())) == want


def test_hard_rows(spark):
    got = pieces.encode_decode(hard_docs(spark), queries.PIECE_MODEL).collect()
    want = [(r[0], LIBRARY.encode(r[1] or "")) for r in hard_rows()]
    want = [(i, ids, LIBRARY.decode(ids) if ids else "") for i, ids in want]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_rows(spark):
    assert pieces.encode_decode(no_docs(spark), queries.PIECE_MODEL).collect() == []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("aabeht in▁.0\n\té日ßＡ\U0001f600"), max_size=40) | st.text(max_size=30))
def test_random_texts(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert own_ids(text) == LIBRARY.encode(text)


def test_long_runs():
    for text in ("a" * 3000, "ab" * 2000, " " * 999, "the" * 1000, "=-" * 500, "é" * 700):
        assert own_ids(text) == LIBRARY.encode(text)
