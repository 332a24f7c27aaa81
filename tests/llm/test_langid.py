import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import langid as L
from tessera.llm.common import read_table

from llm_cases import DOCS, SF

PAGES = "page_id bigint, url string, html string"


def test_held_out_accuracy(spark):
    """Rows whose declaration is withheld or wrong are told by their text."""
    docs = read_table(spark, SF, "documents")
    wrong = (F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 0, F.when(F.col("lang") == "en", "de").otherwise("en"))
             .otherwise(F.col("lang")))
    seen = docs.withColumn("truth", F.col("lang")).withColumn("lang", wrong)
    out = L.judge(seen, L.document_evidence(seen)).select("doc.truth", "doc.lang", "language", "accepted").collect()
    changed = [r for r in out if r["lang"] != r["truth"]]
    assert len(changed) > 30
    assert sum(r["language"] == r["truth"] for r in out) >= 0.95 * len(out)
    assert sum(r["accepted"] for r in out) >= 0.95 * len(out)


def test_evidence_other_than_text(spark):
    """A host whose pages are all French makes a page of one shared word French."""
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    rows = [(i, f"https://www.{'un' if i % 2 else 'deux'}.example.fr/{i}", f"<html lang='fr'><body>{' '.join(word('éaoui') for _ in range(50))}") for i in range(40)]
    rows += [(100 + i, f"http://x.example.de:80/{i}", f'<HTML LANG="de-AT"><p>{" ".join(word("äbcdf") for _ in range(50))}</p>') for i in range(40)]
    rows += [(200, "https://www.un.example.fr/z", "<html><body>zzz</body></html>"), (201, None, None), (202, "no address", "<script>x</script>"),
             (203, "https://neu.example.de/z", "<html><body>zzz</body></html>")]
    df = spark.createDataFrame(rows, PAGES)
    out = {r["page_id"]: r for r in L.judge(df, L.page_evidence(df)).select("doc.page_id", "language", "confidence", "accepted").collect()}
    assert len(out) == len(rows)
    assert out[200]["language"] == "fr" and out[203]["language"] == "de"
    assert all(out[i]["language"] == ("fr" if i < 100 else "de") and out[i]["accepted"] for i in out if i < 200)
    assert not out[201]["accepted"] and not out[202]["accepted"]


def test_defined_cases(spark, odd, none):
    assert L.accepted_documents(none).collect() == []
    kept = L.accepted_documents(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert not {1, 2, 3} & set(ids) and {4, 5, 6, 10, 11} <= set(ids) and ids.count(6) == 2
    undeclared = spark.createDataFrame([(1, "some text", None, "s", 9)], DOCS)
    assert L.judge(undeclared, L.document_evidence(undeclared)).select("language", "accepted").collect() == [(None, False)]


def test_pages_and_documents_together(spark):
    out = L.identify(read_table(spark, SF, "documents"), read_table(spark, SF, "pages"))
    n = read_table(spark, SF, "documents").count(), read_table(spark, SF, "pages").count()
    assert out.filter("doc_id IS NOT NULL").count() == n[0] and out.filter("page_id IS NOT NULL").count() == n[1]
    assert out.filter("accepted AND language = declared").count() >= 0.97 * sum(n)


@pytest.mark.parametrize("few_rows", [1, 2, 5])
def test_rare_language_in_a_large_table(spark, few_rows):
    """A row or two among thousands make a language, which other rows do not fall to."""
    rng = random.Random(12)
    few, many = [["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(200)] for letters in ("aeilmnrst", "ðþáæöhkgvu")]
    text = lambda words: " ".join(rng.choice(words) for _ in range(40))
    rows = [(i, text(few), "en", f"s{i % 3}", 1) for i in range(6000)] + [(6000 + i, text(many), "is", "t", 1) for i in range(few_rows)]
    rows += [(7000 + i, text(many), None, "t", 1) for i in range(3)] + [(8000, "12 34 a 99 %", "en", "s1", 1)]
    df = spark.createDataFrame(rows, DOCS)
    out = {r["doc_id"]: r for r in L.judge(df, L.document_evidence(df)).select("doc.doc_id", "language", "accepted").collect()}
    assert all(out[i]["language"] == ("is" if 6000 <= i < 8000 else "en") and out[i]["accepted"] for i in out)
