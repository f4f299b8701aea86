"""Toxicity: automaton against edit distances, learning on planted terms, held-out accuracy."""

import random
import zlib

from flowline.llm import queries, toxicity
from flowline.llm.toxicity import END, Model, Scorer, Trie

SF = "/root/testdata/sf0.01"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def plain_find(terms, word):
    found = []
    for term in terms:
        letters = term.removesuffix(END)
        whole = term.endswith(END)
        heads = [word] if whole else [word[:n] for n in range(len(word) + 1)]
        n = min(edits(letters, h) for h in heads)
        if n == 0 or n == 1 and len(letters) >= (toxicity.FUZZY_WORD if whole else toxicity.FUZZY_STEM):
            found.append((-n, len(letters), whole, term, n))
    return max(found)[:3] if found else None


def test_automaton_finds_what_edit_distances_find():
    chance = random.Random(1)
    make = lambda low, high: "".join(chance.choice("abcé") for _ in range(chance.randrange(low, high)))
    for _ in range(60):
        terms = {make(4, 8) + chance.choice([END, ""]) for _ in range(6)}
        trie = Trie(terms)
        for _ in range(80):
            word = make(1, 11) if chance.random() < 0.3 else chance.choice(sorted(terms)).removesuffix(END)
            if chance.random() < 0.7:
                at = chance.randrange(len(word))
                word = word[:at] + make(0, 2) + word[at + chance.randrange(2) :]
            got = trie.find(word) if word else None
            want = plain_find(terms, word) if word else None
            assert (got is None) == (want is None)
            if got:
                assert (-got[1], len(got[0].removesuffix(END)), got[0].endswith(END)) == want


def corpus():
    chance = random.Random(3)
    words = [f"{a}{b}{c}" for a in ("ta", "ri", "mo", "qu", "sel") for b in ("na", "le", "xi", "") for c in ("r", "st", "on")]
    rows, labels = [], []
    for i in range(600):
        own = [chance.choice(words) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            own[chance.randrange(40)] = chance.choice(["vileword", "Scoundrel", "zzblah" + chance.choice(words)])
        rows.append((i, " ".join(own) + "."))
        labels.append((i, int(toxic), 1))
    rows += [(700, None), (701, ""), (None, "a vileword without an id"), (0, rows[0][1]), (0, rows[0][1])]
    rows += [(702, "x " * 50_000 + "scoundrel")]
    labels += [(None, 1, 1), (5, None, 1), (6, 0, 0), (999, 1, 1)]
    return rows, labels


def test_learns_planted_terms(spark):
    rows, labels = corpus()
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 as toxic", "1 as score")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int").selectExpr("*", "'t' as text")
    model = toxicity.fit(documents, known)
    assert {"vileword" + END, "scoundrel" + END} <= {t if t.endswith(END) else t + END for t in model.terms} | set(model.terms)
    assert any(t.startswith("zzbl") for t in model.terms)
    got = toxicity.score(documents, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got}
    wrong = [i for i, toxic, _ in labels if i in by_id and toxic is not None and i is not None and (by_id[i] >= 0.7) != bool(toxic)]
    assert wrong == []
    assert by_id[None] >= 0.7 and by_id[702] >= 0.7 and by_id[700] == by_id[701] < 0.5
    kept = toxicity.without_toxic(documents, model)
    assert kept.columns == documents.columns
    assert sorted(str(r[0]) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.score < 0.7)


def test_misspelled_and_quoted():
    scorer = Scorer(Model({"scoundrel" + END: 5.0, "zzblah": 4.0}, {"reported": -3.0}, (4.0, 3.0, 0.0, -3.0)))
    plain, misspelled, quoted, near, clean = scorer.features(
        ["you scoundrel", "you scoundrle scoundral", 'she said "you scoundrel" once', "reported scoundrel here", "fine"]
    ).tolist()
    assert plain[0] > 0 and plain[1:] == [0, 0]
    assert misspelled[1] > 0 and misspelled[0] == 0
    assert quoted[:2] == near[:2] == [0, 0] and quoted[2] > 0 and near[2] > 0
    assert clean == [0, 0, 0]
    open_quote, next_line = scorer.features(['a " mark and a scoundrel', '"\nscoundrel "'])
    assert open_quote[0] > 0 and next_line[0] > 0


def test_labels_of_the_held_out_third_are_never_used(spark):
    rows, labels = corpus()
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    schema = "doc_id bigint, toxic int, quality int"
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    flipped = [(i, 1 - t if held(i) and t is not None else t, q) for i, t, q in labels]
    assert flipped != labels
    assert toxicity.fit(documents, spark.createDataFrame(labels, schema)) == toxicity.fit(
        documents, spark.createDataFrame(flipped, schema)
    )


def test_empty_tables(spark):
    rows, labels = corpus()
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    for model in (toxicity.fit(documents.limit(0), known), toxicity.fit(documents, known.limit(0))):
        assert model == Model({})
        assert len({r.score for r in toxicity.score(documents, model).collect()}) == 1
    assert toxicity.score(documents.limit(0), model).count() == 0


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.95 * len(held)
    # In these tables some toxic labels have no toxic word behind them.
    right = sum(got[i].predicted for i in held if labels[i])
    assert right >= 0.7 * sum(labels[i] for i in held) and right >= 0.95 * sum(got[i].predicted for i in held)
