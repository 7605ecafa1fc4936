"""Ids of a BPE model are those of its merges, scores of a unigram model stay unrounded."""

import random

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from corpusmap.llm import pieces, queries


@pytest.fixture(scope="module")
def model():
    with open(queries.MODEL_FILE, "rb") as f:
        return f.read()


def test_own_ids_of_bpe(spark, model):
    rng = random.Random(1)
    texts = ["segmentation of  unbelievable words\n\n x ", "x" * 300, " " * 40, "漢字é ß 🙂 \t\x00 a", "representation" * 30, "12345 " * 9]
    texts += ["".join(rng.choice("ab theing \n漢é") for _ in range(200)) for _ in range(20)]
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    table = spark.createDataFrame([*enumerate(texts), (90, "▁ a▁b"), (91, None), (92, "")], "doc_id int, text string")
    for chunk in (1 << 16, 7):
        rows = pieces.encode(table, model, chunk=chunk, exact_col="same", reader=pieces.reader_of(model)).collect()
        got = {r.doc_id: r.token_ids for r in rows}
        assert all(r.same for r in rows) and got[91] is None and got[92] == []
        assert [got[i] for i in range(len(texts))] == [library.encode(t) for t in texts]


def test_fractional_scores(model):
    """Two pieces of -0.4 beat one of -1.2, though rounding makes them 0 and -1."""
    spec = proto.ModelProto()
    spec.ParseFromString(model)
    del spec.pieces[259:]
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    for name, score in (("▁", -0.25), ("a", -0.6), ("b", -0.6), ("ab", -1.3), ("c", -0.4), ("d", -0.4), ("cd", -0.7)):
        spec.pieces.add(piece=name, score=score)
    data = spec.SerializeToString()
    own, library = pieces.Pieces(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert pieces.reader_of(data) is pieces.Pieces
    for text in ("ab", "cd", "abcd cdab"):
        assert own.encode(text).tolist() == library.encode(text)
