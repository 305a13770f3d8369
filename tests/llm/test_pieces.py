import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from docsignal.llm import pieces
from helpers import bag, documents, edge_rows, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@pytest.fixture(scope="module")
def reference(model):
    """The library's own unigram search over the same pieces and scores."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    for i, piece in enumerate(proto.pieces):
        if i in model.scores:
            piece.score = model.scores[i]
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def texts():
    chance = random.Random(2)
    alphabet = "aaabcdeehinorst   \n\t.,éüß漢字😀▁0123ABC"
    out = ["".join(chance.choice(alphabet) for _ in range(chance.randrange(120))) for _ in range(300)]
    return out + ["", " ", "   ", "  a  b ", "▁▁x", "\x00", "internationalization of words", "\n" * 40]


def test_ids_equal_the_library(model, reference):
    for text in texts():
        assert model.encode(text).tolist() == reference.encode(text), text


def test_search_is_optimal_on_small_chunks(model):
    def best(chunk):
        table = [0.0] + [-1e18] * len(chunk)
        for e in range(1, len(chunk) + 1):
            for s in range(max(0, e - 16), e):
                score = by_text.get(chunk[s:e])
                if score is None and e - s == 1:
                    score = model.unknown_score
                if score is not None:
                    table[e] = max(table[e], table[s] + score)
        return table[-1]

    names = [b.decode("utf-8", "replace").replace(" ", pieces.BLANK) for b in model.bytes]
    by_text = {names[i]: s for i, s in model.scores.items()}
    for chunk in ["▁internation", "▁zqxj漢", "▁the▁", "aaaaaaaaaa"]:
        ids = [i for i in model.search(chunk) if i in model.scores]
        unknown = sum(c not in model.single for c in chunk)
        total = sum(model.scores[i] for i in ids) + unknown * model.unknown_score
        assert total == pytest.approx(best(chunk))


def test_round_trip_and_broken_ids(model):
    for text in texts():
        assert model.decode(model.encode(text)) == text.replace(pieces.BLANK, " ")
    assert "�" in model.decode(np.array([model.byte_ids[0xE6]], np.int32))


def test_memo_may_be_cleared(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 2)
    small = pieces.PieceModel(PATH)
    assert [small.encode(t).tolist() for t in texts()] == [model.encode(t).tolist() for t in texts()]


def test_tables(spark, model):
    rows = edge_rows()
    encoded = pieces.encode(documents(spark, rows, clashing=True), PATH)
    out = pieces.decode(encoded, PATH).withColumn("same", pieces.restored())
    found = out.collect()
    at_once = pieces.encode(documents(spark, rows, clashing=True), PATH, back=True)
    assert bag(at_once) == bag(out.drop("same"))
    assert len(found) == len(rows) and all(r.same for r in found)
    wanted = sorted(((k, model.encode(t or "").tolist()) for k, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in found), key=repr) == wanted
    assert bag(pieces.decode(pieces.encode(empty(spark), PATH), PATH)) == []


def test_many_words_at_once_equal_each_word_alone_and_the_memo_stays_small(monkeypatch):
    model = pieces.PieceModel(PATH)
    chance = random.Random(8)
    letters = pieces.BLANK + "abcdefghijé漢\n😀"
    texts = ["".join(chance.choice(letters) for _ in range(chance.randrange(0, 60))) for _ in range(400)]
    alone = pieces.PieceModel(PATH)
    want = [alone.encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces, "MEMO_WORDS", 50)
    sizes, got = [], []
    for i in range(0, len(texts), 20):
        got += [x.tolist() for x in model.encode_all(texts[i : i + 20])]
        sizes.append(len(model.memo) + len(model.older))
    assert got == want
    words = {w for t in texts for w in pieces.WORD.findall(pieces.BLANK + t)}
    assert all(model.search(w) == np.frombuffer(alone.memo[w], np.int32).tolist() for w in words)
    assert max(sizes) < len(words)
    assert pieces.PieceModel.of_process(PATH) is pieces.PieceModel.of_process(PATH)
