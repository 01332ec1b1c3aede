import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import languages

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    return languages.document_evidence(spark.read.parquet(f"{FOLDER}/documents.parquet"))


@pytest.fixture(scope="module")
def model(rows):
    return languages.fitted(rows)


def test_text_alone_tells_the_language(rows, model):
    """Without declarations and hosts."""
    bare = rows.withColumn("declared", F.lit(None).cast("string")).withColumn("address", F.lit(None).cast("string"))
    got = languages.identified(bare, model).where("length(text) > 60")
    assert got.where("language = lang and accepted").count() >= 0.99 * got.count()


def test_evidence_helps_short_texts(rows, model):
    got = languages.identified(rows, model)
    assert got.where("language = lang and accepted").count() >= 0.995 * got.count()


def test_odd_rows(odd, rows, model):
    evidence = odd.withColumns({"declared": F.col("lang"), "address": F.col("source")})
    got = languages.identified(evidence, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if not (r.text or "").strip():
            assert (r.language, r.probability, r.accepted) == ("und", 0.0, False)
        assert 0 <= r.probability <= 1 and r.n_words == "w"


def test_empty_and_untaught(empty, odd, model):
    assert languages.identified(languages.document_evidence(empty), model).count() == 0
    untaught = languages.fitted(languages.document_evidence(empty))
    assert languages.identified(languages.document_evidence(odd), untaught).count() == odd.count()


def test_symbols_are_no_language(spark, model):
    df = spark.createDataFrame([(1, "*** 123 !!! ###", "en", "h")], "doc_id long, text string, declared string, address string")
    assert languages.identified(df, model).first().language == "und"


def test_host_priors_decide_what_texts_leave_open(spark, model, rows):
    """A word of no clear language goes with its host, or its suffix if the host is new."""
    german = rows.where("lang = 'de' and length(text) > 300").select("doc_id", "text", F.lit(None).cast("string").alias("declared"))
    seen = german.withColumn("address", F.concat(F.lit("http://www"), (F.col("doc_id") % 3).cast("string"), F.lit(".beispiel.de/a?b")))
    new = spark.createDataFrame([(-1, "qqq", None, "https://neu.de:80/"), (-2, "qqq", None, "www1.beispiel.de")], seen.schema)
    got = {r.doc_id: r.language for r in languages.identified(seen.unionByName(new), model).where("doc_id < 0").collect()}
    assert got == {-1: "de", -2: "de"}


def test_buckets_stay_in_their_rows():
    texts = ["ab", "abc", "", "abcd", None]
    from shelfspark.llm.words import chunks

    ((_, data, offsets),) = chunks(pa.array(texts))
    found = languages.buckets(data, offsets)
    assert [int((found[a:b] != languages.EMPTY).sum()) for a, b in zip(offsets, offsets[1:])] == [0, 1, 0, 2, 0]
    alone = languages.buckets(np.frombuffer(b"abc", np.uint8), np.array([0, 3]))
    assert alone[0] == found[2]


def test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").unionByName(
        spark.createDataFrame([(-1, None, None), (-2, "no scheme", "<p>x")], "page_id long, url string, html string")
    )
    evidence = languages.page_evidence(pages)
    got = languages.identified(evidence, languages.fitted(evidence))
    assert got.where("language = declared").count() >= 0.97 * (got.count() - 2)
    assert got.where("doc_id = -1").first().language == "und"


def test_the_registered_query_scores_all_pages(spark):
    import __spark_entry__

    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = __spark_entry__.queries()["op3_language_id_pages"](spark, FOLDER)
    assert got.columns == ["page_id", "language", "probability", "accepted"]
    joined = got.join(pages, "page_id")
    assert got.count() == pages.count() == joined.count()
    declared = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    assert joined.where((F.col("language") == declared) & F.col("accepted")).count() >= 0.97 * pages.count()
    hosts = pages.select(*languages.address_parts(F.col("url")))
    assert {r[0] for r in hosts.toDF("host", "suffix").select("suffix").distinct().collect()} == {"com", "net", "org"}
