"""Subtracted sketches against set differences, and the order of versions against a plain sort."""

import hashlib
import random
from collections import Counter

import numpy as np

from flowline.llm import queries, sketches
from flowline.llm.sketches import differences, digests, edited

SF = "/root/testdata/sf0.001"


def text_of(chance, words):
    return " ".join(chance.choice("stone river lamp under seven walked noon eight over bread".split()) + str(chance.randrange(90)) for _ in range(words))


def test_differences_are_set_differences():
    chance = np.random.default_rng(6)
    old, new = [], []
    for shared, gone, added in [(0, 0, 0), (5, 0, 0), (0, 3, 0), (50, 1, 1), (500, 40, 0), (10, 300, 400), (0, 2000, 1), (3000, 5, 6)]:
        keys = chance.integers(0, 2**64, shared + gone + added, np.uint64, endpoint=False)
        old.append(keys[: shared + gone])
        new.append(np.concatenate([keys[:shared], keys[shared + gone :]]))
    for cells in (1, sketches.CELLS):
        for a, b, (removed, added) in zip(old, new, differences(old, new, cells)):
            assert set(removed) == set(a) - set(b) and set(added) == set(b) - set(a)
            assert len(removed) + len(added) == len(set(a) ^ set(b))
    assert differences([], []) == []


def test_pieces_make_up_the_text():
    chance = random.Random(2)
    for text in ["", "x", "\n", "\n\n a\n", text_of(chance, 300), "same " * 500, "x" * 5000, "漢字" * 400, "two lines\nof text\n\nand more"]:
        raw = text.encode()
        ends = sketches.cuts(raw) if raw else []
        assert b"".join(raw[a:b] for a, b in zip([0, *ends], ends)) == raw
        assert all(b - a <= sketches.LONGEST_PIECE for a, b in zip([0, *ends], ends))
        found = digests(text)
        assert len(set(found.tolist())) == len(found) == len(ends)


def test_likeness_follows_the_shared_part(spark):
    chance = random.Random(5)
    base = text_of(chance, 800)
    words = base.split()
    rows = [(1, base, base), (2, base, text_of(chance, 800)), (3, base, " ".join(words[:400])), (4, None, ""), (5, None, base)]
    rows += [(6, base, " ".join([*words[:100], "new", *words[101:]])), (None, base, base)]
    got = {r.doc_id: r for r in sketches.compare(spark.createDataFrame(rows, "doc_id bigint, old string, new string").selectExpr("*", "1 as near")).collect()}
    assert got[1].near == got[4].near == got[None].near == 1 and got[5].near == 0 and got[2].near < 0.1
    assert 0.6 < got[3].near < 0.72 and got[3].added.__len__() <= 1 and 0.97 < got[6].near < 1
    assert {d % 2**64 for d in got[6].removed} == set(digests(base).tolist()) - set(digests(rows[5][2]).tolist())


def expected(rows):
    """(doc_id, n_chars, edited_sha256) by a plain sort; rows of one id by the order that was chosen for them."""
    out = []
    for k, (i, text) in enumerate(rows):
        version = edited(text, rows[(k + 1) % len(rows)][1])
        out.append((i, len(text), hashlib.sha256(version.encode()).hexdigest()))
    return Counter(out)


def test_versions(spark):
    chance = random.Random(4)
    rows = [(i * 3 % 100, text_of(chance, chance.randrange(30))) for i in range(100)]
    rows += [(500, None), (501, ""), (502, "é🙂漢" * 50), (None, "no id"), (-5, "negative id"), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as part", "'t' as tie", "2 as ahead")
    ties = {(r.doc_id, r.text or ""): r.h for r in df.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) h").collect()}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), ties[r]))
    for parts in (1, 4, 30):
        got = sketches.compare_with_edits(df, parts).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected(order)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        by_text = {}
        for r in got:
            by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
        assert len({f for s in by_text.values() for f in s}) >= 100
    one = sketches.compare_with_edits(df.filter("doc_id = 502"), 4).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert sketches.compare_with_edits(df.limit(0), 4).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    got = {r.doc_id: r for r in queries.op6_fingerprints(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, after in zip(ids, [*ids[1:], ids[0]]):
        version = edited(docs[i], docs[after])
        assert got[i].n_chars == len(docs[i]) and got[i].edited_sha256 == hashlib.sha256(version.encode()).hexdigest()
        own, other, following = (set(digests(t).tolist()) for t in (docs[i], version, docs[after]))
        assert abs(got[i].near_edited - (2 * len(own & other) / max(1, len(own) + len(other)))) < 1e-9 or not own
        assert abs(got[i].near_next - (2 * len(own & following) / max(1, len(own) + len(following)))) < 1e-9 or not own
    same = {}
    for i, t in docs.items():
        same.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    long = [i for i in docs if len(docs[i]) > 2000]
    assert np.mean([got[i].near_edited for i in long]) > 0.4 > 0.2 > np.mean([got[i].near_next for i in long])
