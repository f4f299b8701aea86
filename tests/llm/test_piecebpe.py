"""SentencePiece BPE against the library itself."""

import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from flowline.llm import piecebpe, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
FILE = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def model():
    return piecebpe.read_model(FILE)


@pytest.fixture(scope="module")
def codec(model):
    return piecebpe.PieceCodec(model)


def odd_texts(model, count):
    draw = random.Random(5)
    pool = "  ▁▁ab cthe\n\té漢字🙂aaeerrsst.,<0x0A><s></s>ーの的不\x00�\xc0́\xad"
    texts = ["".join(draw.choice(pool) for _ in range(draw.choice([1, 2, 3, 5, 10, 40, 200, 900]))) for _ in range(count)]
    texts += ["".join(draw.choice(model.pieces) for _ in range(draw.choice([2, 5, 30, 300]))) for _ in range(count // 3)]
    texts += [" " * k for k in range(50)] + ["▁" * k for k in range(30)] + ["a" * k for k in range(40)]
    return texts + ["", "a" * 20_000, " " * 5000 + "x", "ab" * 3000, "".join(map(chr, range(0x4E00, 0x5800)))]


def test_ids_and_texts_equal_the_library(library, model, codec):
    texts = odd_texts(model, 3000)
    for text, ids in zip(texts, codec.encode(texts)):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want and codec.decode(ids) == library.decode(want), text[:80]


def test_queue_gives_the_same_merges(monkeypatch, library, model):
    monkeypatch.setattr(piecebpe, "LONG_WORD", 2)
    codec, texts = piecebpe.PieceCodec(model), odd_texts(model, 500)
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_any_ids_decode_like_the_library(library, codec):
    draw = random.Random(6)
    for _ in range(20_000):
        kinds = [(0, 32_000), (3, 259), (0, 3), (3 + 0xC0, 259), (3 + 0x80, 3 + 0xC0)]
        ids = [draw.randrange(*draw.choice(kinds)) for _ in range(draw.choice([0, 1, 2, 3, 6, 20]))]
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids)
    with pytest.raises(ValueError):
        codec.decode(np.array([32_000]))


def test_pairs_of_equal_score_merge_from_the_left(codec):
    # Pieces of spaces all have one score, so that a longer one comes before the next pair of spaces.
    symbols = codec.merge_rounds(["▁" * 7])[0]
    assert [codec.symbols[s] for s in symbols] == codec.merge_queue("▁" * 7) == ["▁" * 7]
    assert codec.single.any() and not codec.single.all()


def test_memory_is_bounded_and_changes_nothing(monkeypatch, library, model):
    monkeypatch.setattr(piecebpe, "REMEMBERED", 10)
    codec = piecebpe.PieceCodec(model)
    for at in range(20):
        texts = [f"word{at} and {at * 7919} more", "and more"]
        assert [i.tolist() for i in codec.encode(texts)] == [library.encode(t, add_bos=True, add_eos=True) for t in texts]
        assert len(codec.memory) < 40


ODD = [(1, "Two words"), (2, None), (3, ""), (4, " é漢🙂\n"), (4, " é漢🙂\n"), (None, "no id"), (5, "long words " * 50_000)]


def test_odd_rows(spark, library, model):
    schema = "doc_id bigint, text string, TEXT string, ids int, decoded int, n_tokens int"
    df = spark.createDataFrame([(i, t, "other", 1, 1, 1) for i, t in ODD], schema)
    key = lambda row: (row[0] is not None, row[0] or 0)
    want = [(i, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in ODD]
    encoded = piecebpe.encode(df, model)
    assert sorted([tuple(r) for r in encoded.collect()], key=key) == sorted(want, key=key)
    decoded = [(i, library.decode(ids)) for i, ids in want]
    assert sorted([tuple(r) for r in piecebpe.decode(encoded, model).collect()], key=key) == sorted(decoded, key=key)
    assert piecebpe.round_trip(df.limit(0), model).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert [tuple(r) for r in piecebpe.decode(none, model).collect()] == [(1, "")]


def test_query_equals_the_library(spark, library):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for number, text in documents:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        decoded = library.decode(ids).encode()
        want.append((number, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    found = queries.op12_piece_bpe(spark, SF)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    found = sentencepiece_model_pb2.ModelProto()
    with open(FILE, "rb") as file:
        found.ParseFromString(file.read())
    found.trainer_spec.byte_fallback = False
    path = tmp_path / "other.model"
    path.write_bytes(found.SerializeToString())
    with pytest.raises(ValueError):
        piecebpe.read_model(str(path))
