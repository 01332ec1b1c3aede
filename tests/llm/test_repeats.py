import random

from brute import without_repeats as brute
from samples import SCHEMA, sentence

from shelfspark.llm.repeats import Repeats, without_repeats


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def expected(rows, window=13):
    return sorted(((d, n, n - len(k), " ".join(k)) for d, n, k in brute(rows, window)), key=repr)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = without_repeats(odd)
    assert result(out) == expected(rows)
    assert set(out.columns) == set(odd.columns) | {"kept_text", "n_removed", "removed"}


def test_empty(empty):
    assert without_repeats(empty).count() == 0


def test_passages_in_many_documents(spark):
    rng = random.Random(7)
    passages = [sentence(rng, n) for n in (12, 13, 14, 40, 90)]
    rows = []
    for i in range(150):
        parts = [sentence(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "edit"
            parts += [p[rng.randint(0, 3) :], sentence(rng, rng.randint(0, 6))]
        rows.append((rng.randint(0, 120), " ".join(w for p in parts for w in p)))
    rows = list(dict(rows).items())
    df = spark.createDataFrame([(*r, *[None] * 10) for r in rows], SCHEMA).repartition(5)
    assert result(without_repeats(df)) == expected(rows)
    assert result(without_repeats(df, Repeats(8, 3))) == expected(rows, 8)


def test_spans_are_what_goes(odd):
    for r in without_repeats(odd).collect():
        assert sum(s["last"] - s["first"] + 1 for s in r.removed) == r.n_removed
