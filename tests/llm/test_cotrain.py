import numpy as np

from stratalake.llm import cotrain
from stratalake.llm.cotrain import Examples, classify, co_train, learn, metadata_features, op10_quality_classifier, text_features


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judges = learn(docs, labels.where("doc_id % 2 = 0"))
    rows = classify(docs, judges, ["doc_id"]).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [not r.kept for r in rows if r.quality == 0]
    toxic = [not r.kept for r in rows if r.toxic == 1 and r.quality == 1]
    assert np.mean(good) > 0.95 and np.mean(bad) > 0.85 and np.mean(toxic) > 0.8
    assert all(0 <= x <= 1 for r in rows for x in (r.p_bad, r.p_toxic, r.score))


def test_query_scores_every_document(spark):
    rows = op10_quality_classifier(spark, "/root/testdata/sf0.001").collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 200


def examples(rows):
    return Examples(np.concatenate(rows).astype(np.int32), np.array([len(r) for r in rows]))


def test_views_teach_each_other():
    """A feature that is never labelled is learned through the other view."""
    rng = np.random.default_rng(0)
    n = 2000
    y = rng.integers(0, 2, n).astype(float)
    labelled = np.arange(n) < 200
    text = examples([np.unique([int(10 + v), 100 + (7 if v and not k else 1)]) for v, k in zip(y, labelled)])
    metadata = examples([np.array([int(20 + v)]) for v in y])
    judge = co_train(text, metadata, np.where(labelled, y, np.nan))
    assert judge.text[107] > 0.5
    assert judge.chance(np.array([11]), np.array([21])) > 0.9 > 0.1 > judge.chance(np.array([10]), np.array([20]))


def test_margins_equal_sums():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, cotrain.BUCKETS, k)) for k in (0, 3, 50)]
    weights = rng.normal(size=cotrain.BUCKETS)
    assert np.allclose(examples(rows).margin(weights), [weights[r].sum() for r in rows])


def test_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", None, 5),
            (4, "w " * 300_000, "de", "s", 600_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS Kept", "2 AS _row")
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 1), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    judges = learn(docs, labels)
    assert judges == {"bad": None, "toxic": None}
    out = classify(docs, judges)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "p_bad", "p_toxic", "score", "kept"]
    assert [r.kept for r in out.collect()] == [True] * 5
    assert classify(docs.limit(0), learn(docs.limit(0), labels.limit(0))).count() == 0
    assert len(text_features(None)) > 0 and len(metadata_features(None, None, None)) == 5


def test_null_and_repeated_ids_stay_within_the_sample(spark, monkeypatch):
    from stratalake.llm import cotrain

    monkeypatch.setattr(cotrain, "LABELLED", 50)
    monkeypatch.setattr(cotrain, "UNLABELLED", 200)
    docs = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id", "concat('some text ', id) AS text",
        "'en' AS lang", "'web' AS source", "20L AS n_chars")
    docs = docs.union(docs.where("doc_id = 7").limit(1).crossJoin(spark.range(500)).drop("id"))
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    found = cotrain.sample(docs, labels).collect()
    assert sorted(r.doc_id for r in found if r.bad is not None) == [7, 8]
    assert 100 < sum(r.bad is None for r in found) < 300
    assert any(r.doc_id is None for r in found) and any(r.doc_id is not None for r in found if r.bad is None)
