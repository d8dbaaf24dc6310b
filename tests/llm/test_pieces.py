import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from larch.llm import pieces
from larch.llm.queries import op13_sentencepiece

from tests.conftest import SF_CHECK

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "th", "e", " ", "  ", "    ", "\n", "\t", "▁", "é", "日", "本", "😀", "ﬁ", "\0",
         "　", "the", "ing", " " * 18, "aaaa", "."]


@pytest.fixture(scope="module")
def codec():
    return pieces.read_codec(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _lists(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n:e].tolist() for e, n in zip(ends, counts)]


def _texts():
    rng = random.Random(3)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)]
    runs = [" " * k for k in range(70)] + ["a" * k for k in range(40)]
    return made + runs + ["ab" * 3000, " " * 1500 + "x", "日本" * 2000, "x\n" * 2000]


def test_ids_and_texts_equal_the_library(codec, library):
    texts = _texts()
    ids, counts = codec.encode(texts)
    want = library.encode(texts)
    assert _lists(ids, counts) == want
    assert codec.decode(ids, counts) == library.decode(want)


def test_one_merge_a_round_gives_the_same(library):
    own = pieces.read_codec(MODEL)
    assert own.one_merge is False
    own.one_merge = True
    texts = _texts()[:500]
    assert _lists(*own.encode(texts)) == library.encode(texts)


def test_any_ids_decode_as_in_the_library(codec, library):
    rng = random.Random(4)
    lists = [[rng.choice([rng.randrange(32000), rng.randrange(259), 28705, 259])
              for _ in range(rng.randint(0, 9))] for _ in range(4000)]
    got = codec.decode(np.array([i for ids in lists for i in ids]), np.array(list(map(len, lists))))
    assert got == [library.decode(ids) for ids in lists]
    with pytest.raises(ValueError):
        codec.decode(np.array([32000]), np.array([1]))


def test_slices_of_texts_change_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "SLICE_CHARS", 10)
    texts = ["one two", "two three four", "one five six", "", "seven one two"] * 3
    assert _lists(*pieces.read_codec(MODEL).encode(texts)) == library.encode(texts)


def test_odd_rows(spark, codec):
    rows = [(1, None, "x"), (2, "", "y"), (3, "a b", None), (3, "a b", None), (None, " ", "z")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    told = pieces.with_decoded(pieces.with_ids(docs, codec, out_col="n"), codec, "n", "decoded")
    got = told.select("doc_id", F.size("n"), "decoded", "ids").collect()
    assert {tuple(r) for r in got} == {
        (1, 0, "", "x"), (2, 0, "", "y"), (3, 2, "a b", None), (None, 1, " ", "z")}
    assert len(got) == 5
    assert pieces.with_ids(docs.limit(0), codec).count() == 0
    null = pieces.with_decoded(spark.createDataFrame([(None,)], "ids array<int>"), codec)
    assert null.first()["decoded"] is None


def test_query_equals_the_library(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in op13_sentencepiece(spark, SF_CHECK).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "")
        assert got[doc["doc_id"]] == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
