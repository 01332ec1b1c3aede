import random

from brute import near_duplicates as brute
from samples import SCHEMA, sentence

from shelfspark.llm.components import components
from shelfspark.llm.ngram_join import Similarity, near_duplicates


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for similarity, k, num in ((Similarity(4, 85, 100), 4, 85), (Similarity(), 5, 80)):
        assert result(near_duplicates(odd, similarity)) == brute(rows, k, num)


def test_empty(empty):
    assert near_duplicates(empty).columns == ["doc_id", "n_shingles", "component_id"]
    assert result(near_duplicates(empty)) == []


def test_group_of_edits_and_chains(spark):
    """Edits of one text of which many do not link to it, chains of edits, and a passage that unlike texts share."""
    rng = random.Random(4)
    base, passage = sentence(rng, 120), sentence(rng, 25)
    texts = [base]
    for _ in range(120):
        edited = list(base)
        for _ in range(rng.randint(0, 9)):
            edited[rng.randrange(len(edited))] = f"new{rng.random()}"
        texts.append(edited)
    chain = sentence(rng, 100)
    for i in range(30):
        chain = chain[:i] + [f"link{i}"] + chain[i + 1 :]
        texts.append(chain)
    texts += [passage + sentence(rng, rng.randint(0, 30)) for _ in range(80)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, " ".join(t)) for i, t in zip(ids, texts)]
    df = spark.createDataFrame([(*r, *[None] * 10) for r in rows], SCHEMA).repartition(6)
    assert result(near_duplicates(df, Similarity(4, 85, 100))) == brute(rows, 4, 85)


def test_overlap_bounds():
    s = Similarity(4, 85, 100)
    for a in range(1, 60):
        for b in range(a, 60):
            least = next(i for i in range(a + b) if 100 * i >= 85 * (a + b - i))
            assert s.overlap(a, b) == least
        assert s.prefix(a) == a - -(-85 * a // 100) + 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 3), (200, 201), (5, 5), (7, None), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
