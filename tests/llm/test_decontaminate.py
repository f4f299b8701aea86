"""Spaced-seed decontamination against aligned comparison of all positions."""

import itertools
import random

from flowline.llm import decontaminate as D
from flowline.llm import queries

SF = "/root/testdata/sf0.001"


def plain_words(text):
    import regex

    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())


def plain_match(text, item):
    """Whether some alignment has enough equal words close together."""
    w, v = plain_words(text), plain_words(item)
    if not v:
        return False
    needed = min(D.EQUAL, len(v) - (len(v) >= D.EQUAL))
    for shift in range(-len(v), len(w)):
        m = [k for k in range(len(v)) if 0 <= shift + k < len(w) and w[shift + k] == v[k]]
        if any(m[j + needed - 1] - m[j] < D.WINDOW for j in range(len(m) - needed + 1)):
            return True
    return False


def test_masks_miss_no_window():
    spare = D.WINDOW - D.EQUAL
    for changed in itertools.combinations(range(D.WINDOW), spare):
        assert any(
            all(a + k not in changed for k in mask) for mask in D.MASKS for a in range(D.WINDOW - mask[-1])
        ), changed


def cases():
    chance = random.Random(11)
    word = lambda: chance.choice("ab cd ef gh ij kl mn op qr st uv wx yz éa ño 12".split())
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((30, 14, 12, 11, 10, 9, 8, 7, 6, 5, 0, 40))]
    items += [(20, None), (21, items[0][1]), (None, items[1][1])]
    docs = [(1000, None), (1001, ""), (1002, "short one"), (None, items[0][1])]
    for i, text in items:
        for n in range(0, 12):
            own = (text or "").split()
            for k in chance.sample(range(len(own)), min(len(own), n // 2)):
                own[k] = "other"
            if n > 8 and len(own) > 20:
                own.insert(len(own) // 2, "extra")
            noise = [word() for _ in range(chance.randrange(20))]
            docs.append((len(docs), ", ".join([*noise, *own, *noise[::-1]]).upper()))
    docs += [docs[10], docs[10], (docs[10][0], "same id and another text " * 4)]
    return docs, items


def test_against_all_positions(spark):
    docs, items = cases()
    documents = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as item_id", "'x' as words")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as doc_id", "2 as seed")
    want = sorted(((i is None, i), any(plain_match(t, x) for _, x in items)) for i, t in docs)
    got = D.contamination(documents, benchmark).collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.contaminated) for r in got) == want
    assert {True, False} == {c for _, c in want}
    kept = D.without_passages(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted((r[0] or -1, r[1] or "") for r in kept.collect()) == sorted(
        (i or -1, t or "") for i, t in docs if not any(plain_match(t, x) for _, x in items)
    )
    few = D.find_passages(documents, D.benchmark_seeds(benchmark), block_seeds=25)
    one = D.find_passages(documents, D.benchmark_seeds(benchmark))
    assert sorted(map(str, few.collect())) == sorted(map(str, one.collect()))


def test_empty_tables(spark):
    docs, items = cases()
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert not any(r.contaminated for r in D.contamination(documents, benchmark.limit(0)).collect())
    assert D.contamination(documents.limit(0), benchmark).count() == 0
    assert D.without_passages(documents, benchmark.limit(0)).count() == len(docs)


def test_seeds_miss_no_window_at_either_end(spark):
    """Every way to replace the spare words of a window that begins or ends an item and a document."""
    docs, items = [], []
    for size in (12, 13, 14, 15):
        own = [f"w{size}x{k}" for k in range(size)]
        items.append((size, " ".join(own)))
        for first in (0, size - D.WINDOW):
            for changed in itertools.combinations(range(D.WINDOW), D.WINDOW - D.EQUAL):
                passage = [("other" if k in changed else w) for k, w in enumerate(own[first : first + D.WINDOW])]
                for front, behind in (([], []), (["x"] * 9, []), ([], ["x"] * 9)):
                    docs.append((len(docs), " ".join([*front, *passage, *behind])))
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = dict(docs)
    assert [texts[r.doc_id] for r in D.contamination(documents, benchmark).collect() if not r.contaminated] == []


def test_short_items_are_found_whole_or_with_a_word_replaced(spark):
    """Every length up to WINDOW, and for the longer ones every single word replaced; one missing word is too many."""
    docs, items, want = [], [], []
    for size in range(1, D.WINDOW):
        own = [f"s{size}x{k}" for k in range(size)]
        items.append((size, " ".join(own)))
        variants = [(own, True)]
        for k in range(size):
            variants.append((own[:k] + ["other"] + own[k + 1 :], size >= D.EQUAL))
        variants += [(own[1:], size >= D.EQUAL), (own[:-1] + ["x", own[-1]], size == 1 or size >= D.EQUAL)]
        for words, hit in variants:
            for front, behind in (([], []), (["y"] * 5, ["z"] * 5)):
                docs.append((len(docs), " ".join([*front, *words, *behind])))
                want.append(hit)
    documents = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {r.doc_id: r.contaminated for r in D.contamination(documents, benchmark).collect()}
    wrong = [text for i, text in docs if found[i] != want[i]]
    assert wrong == [] and want == [any(plain_match(t, x) for _, x in items) for _, t in docs]
    seven = spark.createDataFrame([(1, "What is the capital city of France?")], "item_id bigint, text string")
    asked = spark.createDataFrame([(1, "he said: what is the capital city of France, and left")], "doc_id bigint, text string")
    assert D.contamination(asked, seven).first().contaminated


def test_query_and_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    seeds = {}
    for r in items:
        v = plain_words(r.text)
        for k in range(len(v) - 3):
            seeds.setdefault(tuple(v[k : k + 4]), set()).add(r.item_id)
    texts = {r.item_id: r.text for r in items}
    want = {}
    for r in docs:
        w = plain_words(r.text)
        near = set().union(*[seeds.get(tuple(w[k : k + 4]), set()) for k in range(len(w) - 3)])
        want[r.doc_id] = any(plain_match(r.text, texts[i]) for i in near)
    df = queries.op5_decontaminate(spark, SF)
    assert {r.doc_id: r.contaminated for r in df.collect()} == want and any(want.values())
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
