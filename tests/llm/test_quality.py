import numpy as np
from pyspark.sql import functions as F

from quayside.llm import quality
from quayside.llm.quality import (Scorer, Shape, fit_vectors, pair_buckets, quality_scores, score_quality, text_features,
                                  train_quality, word_features)

SF = "/root/testdata/sf0.01"
FEW = Shape(buckets=1 << 12, steps=150)


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_scores(docs, labels)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and scored.count() == docs.count()
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.5) for r in rows)


def test_held_out_rows_teach_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    learn = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    a, b = (train_quality(docs, x, learn, 60, FEW) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_folded_score_is_the_softmax_of_the_mean_vector():
    rows = [(1, *text_features("good plain words here", FEW)), (0, *text_features("junk junk junk!!", FEW))] * 20
    model = fit_vectors(rows, FEW)
    ids, counts = text_features("good junk junk", FEW)
    logit = model.bias + (model.weights[ids] * counts).sum() / counts.sum()
    assert abs(Scorer(model).score(["good junk junk"])[0] - 1 / (1 + np.exp(-logit))) < 1e-12


def test_word_features_do_not_depend_on_the_batch():
    words = ["a", "été", "worth", "x" * 300]
    together = word_features(words, FEW)
    for k, w in enumerate(words):
        assert sorted(together[1][together[0] == k]) == sorted(word_features([w], FEW)[1])


def plain_score(text, model):
    """Feature by feature, without caches or batches."""
    words = (text or "").split()
    hashes = [word_features([w], model.shape)[2][0] for w in words]
    buckets = [b for w in words for b in word_features([w], model.shape)[1]]
    buckets += [b for a in zip(hashes, hashes[1:]) for b in pair_buckets(np.array(a), model.shape)]
    mean = sum(float(model.weights[b]) for b in buckets) / len(buckets) if buckets else 0.0
    return 1 / (1 + np.exp(-(model.bias + mean)))


def test_scores_equal_a_plain_version_whatever_the_batch_and_cache(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["good", "plain", "junk", "\u00e9t\u00e9", "a", "worth", "x" * 70]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(0, 30, 60)] + [None, "", " ", "one"]
    model = fit_vectors([(k % 2, *text_features(t, FEW)) for k, t in enumerate(texts[:40])], FEW)
    wanted = [plain_score(t, model) for t in texts]
    monkeypatch.setattr(quality, "CACHE_WORDS", 4)  # forgets its words all the time
    small = Scorer(model)
    assert np.allclose([s for k in range(0, len(texts), 3) for s in small.score(texts[k:k + 3])], wanted, rtol=0, atol=1e-12)
    assert np.allclose(Scorer(model).score(texts), wanted, rtol=0, atol=1e-12)


def test_pairs_of_words_count_in_their_order():
    ab, ba = (set(text_features(t, FEW)[0]) for t in ("alpha beta", "beta alpha"))
    assert ab != ba and len(ab - ba) == len(ba - ab) == 1


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "good text " * 5000, "c"), (None, "junk", "d"), (4, "x" * 50000, "e")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = quality_scores(docs, labels, 10, FEW).collect()
    assert len(rows) == 5 and all(r.score == 0.5 for r in rows)  # one class is left: nothing can be learned
    assert quality_scores(docs.limit(0), labels.limit(0), 10, FEW).count() == 0
    kept = score_quality(docs, train_quality(docs, labels, None, 10, FEW))
    assert kept.columns == ["doc_id", "text", "score"]
