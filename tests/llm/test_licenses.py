import random

import pytest
from brute import LOWER, words
from samples import sentence

from shelfspark.llm import licenses

SETS = {n: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for n, t in licenses.TEMPLATES.items() for w in [words(t.translate(LOWER))]}


def test_bands_guarantee_retrieval():
    how = licenses.Settings()
    for plan in licenses.plans(licenses.TEMPLATES, how):
        for s in plan.sets:
            j = licenses.least_jaccard(len(s), plan.block, how.containment)
            assert (1 - j**plan.rows) ** plan.bands <= how.miss
            assert len(s) <= 2 * plan.block


def test_planted_and_edited_notices(spark):
    rng = random.Random(5)
    rows, whole = [], {}
    for i in range(300):
        name = rng.choice(sorted(licenses.TEMPLATES))
        notice = licenses.TEMPLATES[name].split()
        if i % 3 == 1:
            notice[rng.randrange(len(notice))] = "edited"
        if i % 3 == 2:
            notice = []
        text = sentence(rng, rng.randint(0, 80)) + [w.upper() if i % 2 else w for w in notice] + sentence(rng, rng.randint(0, 80))
        rows.append((i, " ".join(text)))
        have = {tuple(w[k : k + 5]) for w in [words(" ".join(text).translate(LOWER))] for k in range(len(w) - 4)}
        whole[i] = {n for n, s in SETS.items() if len(s & have) >= 0.8 * len(s)}
    found = {i: set() for i, _ in rows}
    for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r.doc_id].add(r.template)
        w = words(dict(rows)[r.doc_id])
        assert 0 <= r.first_word <= r.last_word < len(w) and 0.8 <= r.containment <= 1
    assert found == whole


def test_odd_rows(odd, empty):
    assert licenses.licenses(odd).count() == 0
    assert licenses.licenses(empty).count() == 0
    some = odd.where("doc_id = 7").first().text
    got = licenses.licenses(odd, {"own": some}).collect()
    assert {r.doc_id for r in got} >= {7} and all(r.template == "own" for r in got)


def test_a_template_needs_a_shingle(odd):
    with pytest.raises(ValueError, match="fewer than 5"):
        licenses.licenses(odd, {"short": "two words"})


def test_short_notices_comment_marks_and_other_punctuation(spark):
    gpl = licenses.MORE_NOTICES["gpl-2.0-notice"].split()
    apache = licenses.TEMPLATES["apache-2.0-notice"].split()
    rows = [
        (1, "(c) 2020 Somebody. All rights reserved", {"all-rights-reserved"}),
        (2, "ALL RIGHTS RESERVED!", {"all-rights-reserved"}),
        (3, "all the rights reserved", set()),
        (4, "Released under the MIT License", {"mit"}),
        (5, "// Released under\n// the MIT License", {"mit"}),
        (6, "﻿“Released under the MIT License”", {"mit"}),
        (7, "\n".join(" * " + " ".join(apache[i : i + 6]) for i in range(0, len(apache), 6)), {"apache-2.0-notice"}),
        (8, "\n".join("dnl " + " ".join(gpl[i : i + 7]) for i in range(0, len(gpl), 7)), {"gpl-2.0-notice"}),
        (9, " ".join(gpl) + " words between " + licenses.TEMPLATES["gpl-3.0-notice"], {"gpl-2.0-notice", "gpl-3.0-notice"}),
        (10, licenses.MORE_NOTICES["cc-by-sa-4.0-notice"].upper(), {"cc-by-sa-4.0-notice"}),
    ]
    got = licenses.licenses(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()
    assert {i: {r.template for r in got if r.doc_id == i} for i, _, _ in rows} == {i: t for i, _, t in rows}
    at = {(r.doc_id, r.template): (r.first_word, r.last_word) for r in got}
    assert at[1, "all-rights-reserved"] == (3, 5) and at[5, "mit"] == (1, 6)


def test_whole_licences_as_text_and_as_comments(spark):
    texts = licenses.full_texts()
    assert {f"{n}-text" for n in ("gpl-2.0", "lgpl-2.1", "mpl-2.0", "isc", "mit", "bsd-2-clause", "bsd-3-clause", "apache-2.0")} <= set(texts)
    names = sorted(texts)
    rows = [(i, f"before it {texts[n]} after it") for i, n in enumerate(names)]
    rows += [(100 + i, "\n".join(f"#   {line}" for line in texts[n].splitlines())) for i, n in enumerate(names)]
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i, name in enumerate(names):
        for doc in (i, 100 + i):
            assert {r.template for r in got if r.doc_id == doc and r.template.endswith("-text")} == {name}
