import zlib

from tessera.llm import quality as Q
from tessera.llm.common import read_table

from llm_cases import DOCS


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in Q.classify(docs, labels).collect()}
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    truth = [(r["quality"], out[r["doc_id"]]) for r in labels.collect() if r["doc_id"] in out]
    test = [(y, r["predicted"]) for y, r in truth if r["held_out"]]
    good, bad = ([p == y for y, p in test if y == k] for k in (1, 0))
    assert len(good) > 300 and len(bad) > 50
    assert sum(good) >= 0.95 * len(good) and sum(bad) >= 0.9 * len(bad)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality", "toxic")
    a, b = (sorted(map(tuple, Q.classify(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_defined_cases(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, 1), (11, 1), (7, 0), (12, 0), (2, 0), (None, 1), (8, None), (99, 0)], "doc_id bigint, quality int")
    out = Q.classify(odd, labels).collect()
    assert len(out) == 15 and all(0 <= r["score"] <= 1 for r in out)
    empty = {r["score"] for r in out if r["doc_id"] in (1, 2)}
    assert len(empty) == 1 and all(r["held_out"] for r in out if r["doc_id"] is None)
    assert Q.classify(none, labels).collect() == []
    assert {r["score"] for r in Q.classify(odd, labels.limit(0)).collect()} == {0.5}
    one = Q.classify(odd, labels.filter("quality = 1")).collect()
    assert len({r["score"] for r in one}) == 1 and one[0]["score"] > 0.5
    assert Q.fit(spark.createDataFrame([], DOCS), labels, train=~Q.held_out()).score(b"x", ()) == 0.5


def test_labels_of_absent_documents_change_nothing(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    absent = spark.range(10**6, 10**6 + 50_000).selectExpr("id AS doc_id", "id % 2 AS quality", "0 AS toxic").to(labels.schema)
    a, b = (sorted(map(tuple, Q.classify(docs, x).collect())) for x in (labels, labels.unionByName(absent)))
    assert a == b and len({r[2] for r in a}) > 10
