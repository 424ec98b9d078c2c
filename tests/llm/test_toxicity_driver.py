import random
import tracemalloc

from helpers import documents

from rillflow.llm.toxicity import WORDS, fit, fit_words, held_out


def corpus(n, words, seed=3):
    rng = random.Random(seed)
    rare = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    common = ["plain", "fine", "weather", "garden", "muslims"]
    return [" ".join([rare() for _ in range(words)] + rng.sample(common, 3) + ["vile", "moron"] * (i % 4 == 0)) for i in range(n)]


def test_only_kept_features_reach_the_driver(spark):
    docs = documents(spark, corpus(300, 1200)).repartition(8).cache()
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic").cache()
    docs.count(), labels.count()
    tracemalloc.start()
    model = fit(docs, labels)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights and most < 6e6  # the sampled rows have 2.5 million features, 10 MB of ids


def test_executors_choose_the_features_that_a_local_fit_chooses(spark):
    texts = corpus(200, 12)
    docs = documents(spark, texts)
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) as toxic")
    used = [r.doc_id for r in docs.where(~held_out(docs["doc_id"])).select("doc_id").orderBy("doc_id").collect()]
    for how in ({}, {"max_features": 5}, {"least": 20}):
        far = fit(docs, labels, **how)
        near = fit_words([(set(WORDS.findall(texts[i])), int(i % 4 == 0)) for i in used], **how)
        assert far.weights.keys() == near.weights.keys() and far.weights
        assert all(abs(far.weights[k] - near.weights[k]) < 1e-9 for k in far.weights)
