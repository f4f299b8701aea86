"""SimHash fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")

from flowline.llm import queries, simhash  # noqa: E402
from flowline.llm.components import connected_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, words=4):
    own = bytes(text.encode()).lower().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    return {n: top(n) for n in nodes}


def classes_of(values, distance=4):
    """Components of numbers by all pairs."""
    own = sorted(set(values))
    pairs = [(a, b) for i, a in enumerate(own) for b in own[:i] if (a ^ b).bit_count() <= distance]
    return roots(own, pairs)


def test_fingerprints_as_defined():
    texts = ["", "  \t\n", "One", "a B c", "A b c D", "é É ÀB  x y\x0bz\x1cq", "w " * 500, "the same the same the same"]
    chance = random.Random(1)
    texts += [" ".join(chance.choice("abcdefgh") for _ in range(chance.randrange(1, 400))) for _ in range(50)]
    for text in texts:
        assert simhash.fingerprint(text) == simhash.fingerprint(text, piece=7) == plain_fingerprint(text)


def test_segments_miss_no_pair():
    chance = random.Random(3)
    for n in (2, 3, 4, 5, 7):
        own = simhash.segments_of(n, 4)
        for _ in range(300):
            mask = sum(1 << b for b in chance.sample(range(64), 4))
            assert any((mask >> s.shift & (1 << s.width) - 1).bit_count() <= s.radius for s in own)
    assert len(simhash.ball(range(10), 2)) == 1 + 10 + 45
    for n, distance in ((1, 4), (3, 3)):
        with pytest.raises(ValueError):
            simhash.segments_of(n, distance)


@pytest.mark.parametrize("bucket_pairs", [1024, 3, 0])
def test_links_connect_what_all_pairs_connect(spark, bucket_pairs):
    chance = random.Random(7)
    values = [chance.getrandbits(64) for _ in range(40)]
    for center in values[:6]:  # dense clouds and chains
        for _ in range(25):
            values.append(center ^ sum(1 << b for b in chance.sample(range(64), chance.randrange(1, 7))))
        step = center
        for _ in range(8):
            step ^= sum(1 << b for b in chance.sample(range(64), 4))
            values.append(step)
    values += [0, 1, 2**64 - 1, 2**63]
    want = classes_of(values)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in sorted(set(values))]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), bucket_pairs=bucket_pairs).collect()
    found = [(r.a % 2**64, r.b % 2**64) for r in links]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert roots(set(values), found) == want
    if bucket_pairs == 1024:
        assert {frozenset(p) for p in found} == {
            frozenset((a, b)) for a in set(values) for b in set(values) if a < b and (a ^ b).bit_count() <= 4
        }


def test_components(spark):
    chance = random.Random(9)
    nodes = list(range(-150, 150))
    pairs = [(chance.choice(nodes), chance.choice(nodes)) for _ in range(140)] + [(1, 1), (5, 4), (5, 4), (4, 5)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)]
    want = roots({n for p in pairs for n in p}, pairs)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame([*pairs, (None, 3)], "a bigint, b bigint")).collect()}
    alone = {n for n in want if all(a == b for a, b in pairs if n in (a, b))}
    assert got == {n: r for n, r in want.items() if n not in alone}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


NOTE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ROWS = [
    (5, NOTE, "k"), (3, NOTE.upper(), "k"), (9, NOTE, None), (9, NOTE, None),
    (7, None, None), (2, "", "x"), (8, " \n", "x"), (None, NOTE, "n"), (None, "text of its own without any id", "n"),
    (None, "text of its own without any id", "n"), (1, "quite another text that has nothing in common", "z"),
]


def test_rows_and_groups(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, fp string").selectExpr("*", "1 as component_id", "2 as TEXT")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(ROWS)
    ids = {(r.doc_id, r.component_id) for r in found}
    assert ids == {(5, 3), (3, 3), (9, 3), (7, 2), (2, 2), (8, 2), (None, 3), (None, None), (1, 1)}
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted(
        [(3, NOTE.upper()), (2, ""), (None, "text of its own without any id"), (1, ROWS[-1][1])], key=str
    )
    assert simhash.near_duplicates(df.limit(0)).count() == simhash.one_per_group(df.limit(0)).count() == 0


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    tops = classes_of(prints.values())
    first = {}
    for i in sorted(docs):
        first.setdefault(tops[prints[i]], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", first[tops[p]]) for i, p in prints.items()}
