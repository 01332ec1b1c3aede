import re

import pytest

from shelfspark.llm.contamination import Windows, contaminated, decontaminated

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(n_words, hit words, items) of each text, place by place."""
    out = []
    for text in docs:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            w = words(passage)
            size = min(k, len(w))
            windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size and item is not None else set()
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((len(own), sorted(hit), sorted(found)))
    return out


PASSAGE = "The quick brown fox jumps over the lazy dog while seven wizards watch"
ITEMS = [(1, PASSAGE), (2, PASSAGE + " again"), (10, "short one"), (3, "z"), (4, None), (5, " -- !"), (None, "orphan item without an id"), (6, PASSAGE), (2, "other text of one item")]
DOCS = [
    "Before it: the QUICK brown fox; jumps over\nthe lazy dog -- while seven wizards watch. After it",
    "the quick brown fox jumps over the lazy dog while seven Wizards watch again " * 3,
    "nothing here at all",
    "a Short-one! and a short one, z",
    "fox jumps over the lazy dog while seven wizards",  # nine words of it
    "other text of one item; orphan item without an id",
    None, "", " ?! ", "Ünïcode wörds 漢字 z ÉTÉ",
    "filler words go on and on " * 4000 + PASSAGE.upper() + " and on " * 500,
]


@pytest.fixture
def tables(spark):
    rows = [(i % 9 if i != 3 else None, t, "x", 7, ["a"]) for i, t in enumerate(DOCS + DOCS[:2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_hit int, hits array<string>").repartition(3)
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def check(df, items, k=10):
    rows = df.collect()
    got = [(r.n_words, [w for x in r.hits for w in range(x["first"], x["last"] + 1)], r["items"]) for r in rows]
    assert got == brute([r.text for r in rows], items, k) and [r.n_hit for r in rows] == [len(g[1]) for g in got]
    return rows


@pytest.mark.parametrize("how", [Windows(), Windows(slice_bytes=100), Windows(3), Windows(1)])
def test_against_brute_force(tables, how):
    docs, benchmark = tables
    rows = check(contaminated(docs, benchmark, how), ITEMS, how.n_words)
    assert len(rows) == len(DOCS) + 2


def test_removal(tables):
    docs, benchmark = tables
    left = decontaminated(docs, benchmark, documents=True).collect()
    assert sorted(str(r.text) for r in left) == sorted(str(t) for t, b in zip(DOCS, brute(DOCS, ITEMS)) if not b[1])
    texts = {r.text for r in decontaminated(docs, benchmark).collect()}
    assert "Before it: . After it" in texts and "a -! and a , " not in texts and None in texts
    assert "nothing here at all" in texts
    again = contaminated(decontaminated(docs, benchmark), spark_rows(docs, [(1, PASSAGE)]))
    assert {r.n_hit for r in again.collect()} == {0}


def spark_rows(docs, rows):
    return docs.sparkSession.createDataFrame(rows, "item_id long, text string")


def test_empty(tables, empty):
    docs, benchmark = tables
    assert contaminated(empty, benchmark).count() == 0
    assert {(r.n_hit, tuple(r["items"])) for r in contaminated(docs, benchmark.limit(0)).collect()} == {(0, ())}


def test_odd_rows(odd, tables):
    check(contaminated(odd, spark_rows(odd, [(1, "three words only"), (2, "漢字 🙂")])), [(1, "three words only"), (2, "漢字 🙂")])
