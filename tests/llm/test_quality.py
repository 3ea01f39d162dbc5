"""The classifier learns from learning rows only, separates held-out ones, and survives odd inputs."""

import zlib

import pyarrow as pa
from edge_docs import SF, edge_docs, edge_rows, empty_docs

from prodlink.llm import subword as Q
from prodlink.llm.common import table


def test_held_out_accuracy(spark):
    df = Q.op2_quality(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    rows = df.collect()
    out = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all((r.predicted == 1) == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r.quality for r in out) / len(out) > 0.95
    good = [r for r in out if r.quality == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.97


def test_labels_of_held_out_rows_are_not_used(spark):
    labels = table(spark, SF, "labels")
    kept = Q.training_sample(table(spark, SF, "documents"), labels, "quality")
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids and not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_edge_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 150)] + [(101, None), (None, 1)], "doc_id long, quality int")
    docs = edge_docs(spark)
    rows = Q.score(docs, Q.fit(docs, labels), ["doc_id"]).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id == 9}
    assert len(same) == 1
    none = Q.fit(docs, labels.filter("false"))
    assert {r.score for r in Q.score(docs, none, ["doc_id"]).collect()} == {0.5}
    assert Q.score(empty_docs(spark), none, ["doc_id"]).count() == 0


def test_scalar_form_equals_features_by_hand():
    make = Q.Featurizer()
    texts = pa.array(["aa bb bb", "", "x"])
    import numpy as np
    rng = np.random.default_rng(0)
    m = Q.Model(rng.normal(size=1 << Q.BUCKETS_LOG2).astype(np.float32), 0.25)
    one = [m.score(pa.array([t]))[0] for t in texts.to_pylist()]
    assert np.allclose(one, m.score(texts))  # neighbours do not matter
    parts = list(make(np.frombuffer(b"aa bb bb", np.uint8), np.array([0, 8])))
    assert [len(b) for b, _ in parts] == [3, 1, 0, 6, 5, 4]  # words, repeats at 1 and 2, 3-, 4-, 5-grams
