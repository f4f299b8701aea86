"""Byte-level BPE, token counts and token-id files against the libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
zstandard = pytest.importorskip("zstandard")

from tokenizers import Tokenizer  # noqa: E402

from flowline.llm import bpe, counting, frames, queries  # noqa: E402
from flowline.llm.units import Memory, read_definition  # noqa: E402
from flowline.session import scratch_path  # noqa: E402

SF = "/root/testdata/sf0.001"

ODD = [
    (1, "Plain words, and  double  spaces \n\n at the end \n "),
    (2, None),
    (3, ""),
    (4, "é漢字🙂‍🙂 naïve ​zero nb   x y \x1c\x1d\x85z"),
    (5, "aaaaaaaa" * 3000),
    (6, "x<|endoftext|>y <|endoftext|> z <|startoftext|> <|end"),
    (7, "it's I'LL we've 123456 ½ ²x ...!!! ====\t\t--\r\n\x00\x7f"),
    (7, "it's I'LL we've 123456 ½ ²x ...!!! ====\t\t--\r\n\x00\x7f"),
    (None, "row without an id"),
    (9, " ".join(f"w{i * 7919 % 1000}" for i in range(30000))),
    (10, "éa ́b  c　D İstanbul ΣΑΣ"),
]
SCHEMA = "doc_id bigint, text string, TEXT string, ids string, decoded int, n_tokens string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "other", "x", 1, "y") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def definition():
    return queries.byte_bpe_definition()


def test_encodes_and_decodes_like_the_rank_library(odd, reference, definition):
    got = [(r.doc_id or 0, r.ids, bytes(r.decoded)) for r in bpe.round_trip(odd, definition).collect()]
    assert sorted(got) == sorted((i or 0, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in ODD)


def test_separate_encode_and_decode(odd, reference, definition):
    encoded = bpe.encode(odd, definition)
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded, definition).collect()} == {
        i: (t or "").encode() for i, t in ODD
    }


def test_spans_cover_whole_characters(odd, definition):
    for row in bpe.encode(odd, definition, spans=True).collect():
        text = next(t for i, t in ODD if i == row.doc_id) or ""
        assert len(row.ids) == len(row.char_start) == len(row.char_end)
        if row.ids:
            assert row.char_start[0] == 0 and row.char_end[-1] == len(text)
        assert all(b <= e and e >= b2 for e, b, b2 in zip(row.char_end, row.char_start[1:] + [len(text)], row.char_start))
    codec = bpe.codec_of(definition)
    ids = codec.encode(["🙂"])[0]
    starts, ends = codec.spans("🙂".encode(), ids)
    assert set(starts) == {0} and set(ends) == {1} and codec.n_split(ids) == len(ids) - 1 > 0


def test_random_strings_encode_alike(reference, definition):
    chance, codec = random.Random(5), bpe.codec_of(definition)
    alphabet = "aab  \n\tés'tx1½,.=-🙂漢 ​"
    texts = ["".join(chance.choice(alphabet) for _ in range(chance.randrange(60))) for _ in range(3000)]
    texts += [c * n for c in "a =-\n'0" for n in range(1, 80)]
    assert [list(ids) for ids in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    assert all(codec.decode(ids) == t.encode() for ids, t in zip(codec.encode(texts), texts))


def test_any_bytes_decode(definition):
    codec = bpe.codec_of(definition)
    assert sorted(t for t in codec.tokens if len(t) == 1) == [bytes([i]) for i in range(256)]
    ids = np.random.default_rng(4).integers(0, len(codec.tokens), 500)
    assert codec.decode(ids) == b"".join(codec.tokens[i] for i in ids) and codec.decode(ids[:0]) == b""
    with pytest.raises(ValueError):
        codec.decode(np.array([len(codec.tokens)]))


def test_counts_like_the_library(odd):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    text = read_definition(P.path("byte_bpe_50k.json"))
    want = sorted(((i or -1), len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False))) for i, t in ODD)
    for chunk, overlap in ((counting.CHUNK_CHARS, counting.OVERLAP_CHARS), (50, 8), (7, 1)):
        got = counting.count_tokens(odd, text, chunk_chars=chunk, overlap_chars=overlap).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want


def test_overlaps_widen_until_they_agree():
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    counter = counting.Counter(read_definition(P.path("byte_bpe_50k.json")))
    chance = random.Random(2)
    for _ in range(300):
        text = "".join(chance.choice(["word", " ", "  ", "é", "🙂", "<|endoftext|>", "longwithoutanyspace" * 3, "\n", "x"]) for _ in range(60))
        count = counting.count_in_chunks(text, counter.offsets, chance.randrange(1, 60), chance.randrange(1, 10))
        assert count == len(own.encode(text, add_special_tokens=False))


def test_memory_forgets_and_makes_again():
    asked = []
    memory = Memory(lambda key: asked.append(key) or key.upper(), limit=2)
    for keys in ("abc", "ad", "efg", "a", "hij", "d"):
        memory.tidy()
        assert [memory[k] for k in keys] == list(keys.upper())
    assert "".join(asked) == "abcdefghijd"


def expected_ids(rows):
    own = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((i, start, len(ids), ids.tobytes()))
        start += len(ids)
    return out


def test_words_are_remembered_once_in_small_letters():
    own = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    encoder = frames.IdBytes(read_definition(P.path("word_bpe_49k.json")), None)
    texts = ["Straße\u00c9t\u00e9, \u00c9T\u00c9! it's IT'S it'S", "a\x1cb \x1dC\x1f\u0085D\u00a0E\u2028F", "<|ENDOFTEXT|> x", "<|endoftext|> X<|endoftext|>Y"]
    texts += ["\u0391\u03a3 \u0130I E\u0301 \u212b \u4e2d\u6587\u3002", "", " \n\t", "9a.B,c;;D 1.5% A.", "\u03a3A \u00b5\u00df\u00ff\u00d7\u00d0"]
    chance = random.Random(5)
    alphabet = "aBcZ\u00c9\u00e9\u00df\u00d7 '.,!<|>9\n\x1e\u00a0\u03a3\u0301\u0130<"
    texts += ["".join(chance.choices(alphabet, k=chance.randrange(40))) for _ in range(3000)]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts) == want and encoder.encode(texts[::-1]) == want[::-1]
    encoder = frames.IdBytes(read_definition(P.path("word_bpe_49k.json")), None)
    asked = []
    real = encoder.units.encode_unit
    encoder.units.encode_unit = lambda unit: asked.append(unit) or real(unit)
    encoder.encode(["The cat, the CAT.\nTHE Cat! the\tcat cat,"])
    assert sorted(asked) == ["!", ",", ".", "cat", "the"]


def test_files_hold_the_ids_in_order(spark, odd):
    folder = scratch_path(spark, "frames-test")
    frames.write_token_files(odd, folder, read_definition(P.path("word_bpe_49k.json")), 2, 3)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in frames.read_token_files(spark, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_ids(ODD)
    some = frames.read_token_files(spark, folder, [7, 9, 12345]).collect()
    assert sorted(r.doc_id for r in some) == [7, 7, 9]
    files, root = frames.open_folder(folder)
    name = f"{root}/{spark.read.parquet(folder + '/_manifest').first().file}"
    with open(name, "rb") as file:
        raw = file.read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert zlib.crc32(whole) and len(whole) % 4 == 0
    with open(name, "wb") as file:
        file.write(raw[:20] + bytes([raw[20] ^ 1]) + raw[21:])
    with pytest.raises(Exception, match="damaged frame|decompress|Zstd|zstd"):
        frames.read_token_files(spark, folder).collect()


def test_any_changed_byte_of_a_frame_is_an_error(tmp_path):
    with open(tmp_path / "ids", "wb") as file:
        writer = frames.FrameWriter(file)
        writer.add(1, np.full(5000, 7, "<u4").tobytes())  # some bytes of its frame can change and give the same ids
        writer.close()
    raw = (tmp_path / "ids").read_bytes()
    files, root = frames.open_folder(str(tmp_path))
    for at in range(writer.entries[0][1]):
        (tmp_path / "ids").write_bytes(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :])
        with files.open_input_file(f"{root}/ids") as source, pytest.raises(ValueError, match="damaged frame"):
            list(frames.FrameReader(source).frames(np.arange(1)))


def test_cut_file_is_an_error():
    class Source:
        def __init__(self, raw):
            self.raw = raw

        def size(self):
            return len(self.raw)

        def read_at(self, n, at):
            return self.raw[at : at + n]

    for raw in (b"", b"x" * 100):
        with pytest.raises(ValueError):
            frames.FrameReader(Source(raw))


def test_empty_tables(spark, odd, definition):
    none = odd.limit(0)
    text = read_definition(P.path("word_bpe_49k.json"))
    folder = scratch_path(spark, "frames-empty")
    frames.write_token_files(none, folder, text, 2, 3)
    assert frames.read_token_files(spark, folder).count() == 0
    assert counting.count_tokens(none, read_definition(P.path("byte_bpe_50k.json"))).count() == 0
    assert bpe.round_trip(none, definition).count() == 0


def test_queries(spark, reference):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op3_byte_bpe(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        ids = reference.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in queries.op7_token_counts(spark, SF).collect():
        n = len(own.encode(docs[r.doc_id], add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)
    want = [(i, s, n, zlib.crc32(raw)) for i, s, n, raw in expected_ids(docs.items())]
    assert sorted(map(tuple, queries.op9_token_files(spark, SF).collect())) == want
