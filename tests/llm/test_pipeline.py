"""The pipeline against plain versions of its stages."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from brute import counts, near_duplicates, without_repeats
from samples import odd_rows, sentence

from shelfspark.llm.storage import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, kept boolean, language int, __runs int, n_words string"


def documents(spark):
    rng = random.Random(8)
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source, *_ in odd_rows() if i is None or i != 10 and i != 11]
    passage = sentence(rng, 70)
    for i in range(100, 160):
        text = sentence(rng, rng.randint(12, 200))
        if i % 4 == 0:
            text = text[:5] + passage + text[5:]
        rows.append((i, " ".join(text), "en", "src0", 1))
    copy = rows[-1][1].split()
    copy[len(copy) // 2] = "swapped"
    rows += [(200, " ".join(copy) if len(copy) > 60 else rows[-1][1], "en", "src1", 2), (201, "*** ### 12 34 56 78 90 11 12 13 14 15", "en", "src1", 3)]
    return spark.createDataFrame([(*r, "c", True, 1, 2, "w") for r in rows], SCHEMA).repartition(4)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(spark):
    docs = documents(spark)
    columns = docs.columns
    folder = "/root/testdata/sf0.01"
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = stored(stage(spark, docs, folder), name)
        after = rows_of(docs)
        kept[name] = len(after)
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "language_id":
            # Only texts without letters, or of less than a trigram, go.
            assert Counter(after) == Counter(r for r in before if any(c.isalpha() for c in r[1] or "") and len(r[1].encode()) > 2)
        elif name == "quality_rules":
            assert not Counter(after) - Counter(before)
            for r in after:
                n, _, _, _, repeats = counts(r[1])
                assert n >= 10 and 100 * repeats <= 20 * n
            failing = [r for r in before if counts(r[1])[0] < 10 or 100 * counts(r[1])[4] > 20 * counts(r[1])[0]]
            assert len(after) >= 0.9 * (len(before) - len(failing))
        elif name == "ngram_jaccard":
            groups = near_duplicates([(r[0], r[1]) for r in before], 5, 80)
            ids = Counter(r[0] for r in after if r[0] is not None)
            assert set(ids) == {d for d, _, c in groups if d is not None and d == c} and max(ids.values()) == 1
            assert sum(r[0] is None for r in after) == sum(r[0] is None for r in before)
        elif name == "substring_dedup":
            want = {d: (n, k) for d, n, k in without_repeats([(r[0], r[1]) for r in before])}
            old = {r[0]: r for r in before}
            for r in after:
                n, words = want[r[0]]
                if len(words) == n:
                    assert r == old[r[0]]
                else:
                    assert r[1] == " ".join(words) and r[4] == len(r[1])
            assert len(after) == len(before)
    pieces = defaultdict(list)
    for r in docs.collect():
        pieces[r.sequence_id].append((r.offset, r.length))
    for places in pieces.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_documents(spark, tmp_path):
    documents(spark).where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
