"""Language ID by held-out accuracy, pseudo-likelihood by what it prefers, and the pipeline."""

import math
import random
from collections import Counter

import corpus_pipeline
import messy
import numpy as np
import pyarrow as pa
from cellferry.llm import QUERIES, language, load_all, scoring
from pyspark.sql import functions as F

load_all()


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    made = QUERIES["op7_language"](spark, small).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(made) == docs.count()
    tested = [r for r in made if r.held_out]
    assert len(tested) > 20 and np.mean([r.lang == r.lang_pred for r in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in made)


def test_held_out_labels_do_not_matter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("out", language.held_out())

    def predicted(df):
        model = language.fit(df.where("not out").select(F.col("doc_id").alias("id"), "text", "lang"))
        return {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, model).collect()}

    lied = docs.withColumn("lang", F.when(F.col("out"), "xx").otherwise(F.col("lang")))
    assert predicted(docs) == predicted(lied)


def test_languages_of_messy_rows(docs, none):
    learned = docs.select(F.col("doc_id").alias("id"), "text", "lang")
    model = language.fit(learned)
    made = language.predict(docs, model)
    assert made.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    rows = made.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert language.predict(none, model).count() == 0
    empty = language.fit(none.select(F.col("doc_id").alias("id"), "text", "lang"))
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}


def test_the_folded_product_is_the_kernel_regression():
    texts = pa.array(["the cat and the dog", "der hund und die katze", "le chat et le chien"] * 3 + ["the end", "das ende"])
    labels = ["en", "de", "fr"] * 3 + ["en", "de"]
    rows = language.presence(texts)
    packed = np.packbits(rows, axis=1)
    model = language.learn(packed, labels, landmarks=11)
    assert [model.languages[k] for k in language.scores(model, texts).argmax(1)] == labels
    direct = np.array([[len(set(np.flatnonzero(a)) & set(np.flatnonzero(b))) for b in rows] for a in rows], float)
    direct /= np.sqrt(np.outer(rows.sum(1), rows.sum(1).astype(float)))
    assert np.allclose(language.kernel(packed, packed), direct, atol=1e-5)


def test_scores_prefer_texts_in_order(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng, some = random.Random(1), [r for r in docs.where("length(text) > 800").limit(150).collect()]
    shuffled = []
    for r in some:
        w = r.text.split()
        rng.shuffle(w)
        shuffled.append((r.doc_id + 10**6, " ".join(w)))
    both = docs.union(spark.createDataFrame(shuffled, "doc_id long, text string")).repartition(4)
    found = {r.doc_id: r for r in scoring.score(both).collect()}
    better = [found[r.doc_id].mean_log_likelihood > found[r.doc_id + 10**6].mean_log_likelihood for r in some]
    assert np.mean(better) > 0.8
    assert all(r.log_likelihood <= 0 for r in found.values())


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(2)
    network = scoring.Network.fresh(rng.random(scoring.OUTCOMES) * 9)
    network = scoring.Network(network.flat.astype(np.float64))
    around, word = rng.integers(0, scoring.OUTCOMES + 1, (40, 4)), rng.integers(0, scoring.OUTCOMES, 40)
    grads, parts = scoring.Network(np.zeros(scoring.Network.size())), []
    network.forward(around, word, parts)
    for name, at, slope in parts:
        getattr(grads, name)[at] += slope
    for at in [*np.flatnonzero(grads.flat)[:: len(np.flatnonzero(grads.flat)) // 25]]:
        told = []
        for step in (1e-5, -1e-5):
            network.flat[at] += step
            told.append(-network.forward(around, word).mean())
            network.flat[at] -= step
        assert np.isclose((told[0] - told[1]) / 2e-5, grads.flat[at], rtol=1e-3, atol=1e-7)


def _plain_log_probability(network, around, word):
    """The same in plain Python, without a shift and word by word."""
    hidden = []
    for k in range(scoring.WIDTH):
        hidden.append(math.tanh(network.bias[k] + sum(network.near[p][a][k] for p, a in enumerate(around))))

    def chosen(matrix, bias, target):
        logits = [bias[j] + sum(h * matrix[k][j] for k, h in enumerate(hidden)) for j in range(network.side)]
        return logits[target] - math.log(math.fsum(map(math.exp, logits)))

    c, m = divmod(int(word), network.side)
    return chosen(network.to_class, network.class_bias, c) + chosen(network.to_member[c], network.member_bias[c], m)


def test_log_probabilities_agree_with_plain_python():
    rng, side = np.random.default_rng(8), 3
    network = scoring.Network(rng.normal(0, 2, scoring.Network.size(side)), side)
    around, word = rng.integers(0, side * side + 1, (30, 4)), rng.integers(0, side * side, 30)
    told = [_plain_log_probability(network, a, w) for a, w in zip(around, word)]
    assert np.allclose(network.forward(around, word), told, atol=1e-9)
    every = np.array([network.forward(around, np.full(30, w)) for w in range(side * side)])
    assert np.allclose(np.exp(every).sum(0), 1)


def test_very_low_and_high_logits_keep_their_probabilities():
    network = scoring.Network(np.zeros(scoring.Network.size(2), np.float32), 2)
    network.class_bias[:] = [-5000, -5003]
    network.member_bias[:] = [[4000, 4000], [0, -900]]
    told = network.forward(np.full((4, 4), 4), np.arange(4))
    first = -math.log1p(math.exp(-3))
    assert np.allclose(told, [first - math.log(2)] * 2 + [first - 3, first - 903], rtol=1e-5)


def test_a_step_moves_what_a_dense_step_moves():
    rng, side = np.random.default_rng(4), 5
    start = rng.normal(0, 0.5, scoring.Network.size(side))
    around, word = rng.integers(0, side * side + 1, (50, 4)), rng.integers(0, side * side, 50)
    sparse, memory = scoring.Network(start.copy(), side), scoring.Network(np.full(len(start), 1e-8), side)
    scoring.learn(sparse, around, word, memory, 0.2)
    dense, parts = scoring.Network(np.zeros(len(start)), side), []
    scoring.Network(start.copy(), side).forward(around, word, parts)
    for name, at, slope in parts:
        getattr(dense, name)[at] += slope
    moved = start - 0.2 * dense.flat / (np.sqrt(1e-8 + dense.flat**2) + 1e-6)
    assert np.allclose(sparse.flat, moved)


def test_weights_are_averaged_by_words_in_a_tree(spark):
    rng, tasks = np.random.default_rng(6), 2 * scoring.FAN + 9
    moved, seen = rng.normal(size=(tasks, 2, 7)).astype(np.float32), rng.integers(1, 90, tasks)
    sent = [(b, t, int(seen[t]), (moved[t, b] * np.float32(seen[t])).tobytes()) for t in range(tasks) if t != 3 for b in range(2)]
    df = spark.createDataFrame(sent, "block int, task int, seen long, moved binary").repartition(5)
    some = np.arange(tasks) != 3  # a task without words sends nothing
    mean = (moved[some] * seen[some, None, None]).sum(0) / seen[some].sum()
    found = {r["block"]: np.frombuffer(r["moved"], np.float32) / r["seen"] for r in scoring.averaged(df, tasks).collect()}
    assert sorted(found) == [0, 1] and all(np.allclose(found[b], mean[b], atol=1e-5) for b in found)


def test_words_that_share_an_outcome_have_their_own_likelihood(spark):
    once = [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(100)]
    rows = scoring.score(spark.createDataFrame(once, "doc_id long, text string").repartition(2)).collect()
    assert abs(np.mean([r.mean_log_likelihood for r in rows]) + np.log(20000)) < 0.3


def test_outcomes_grow_with_the_corpus(spark):
    counted = spark.range(6000).select(F.xxhash64("id").alias("word"), F.lit(50).cast("long").alias("n"))
    known = scoring.vocabulary(counted)
    assert len(known.own) == 6000 and known.side**2 * 3 >= 6000 * 4 and known.counts.sum() == 300000
    words = np.append(known.own, [1, -5])
    assert len(set(known.outcomes(words)[:6000].tolist())) == 6000 and all(known.outcomes(words)[6000:] >= 6000)


def test_scores_of_messy_rows(docs, none):
    rows = scoring.score(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in messy.texts_of(docs))
    for r in rows:
        assert (r.mean_log_likelihood is None) == (r.n_words == 0) and (r.n_words or r.log_likelihood == 0)
    equal = [round(r.log_likelihood, 6) for r in rows if r.doc_id == 2]
    assert len(set(equal)) == 1
    assert scoring.score(none).count() == 0


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    junk = spark.createDataFrame([(10**6, None, "en", "s", None), (10**6 + 1, "12 34 --", "en", "s", 8)], docs.schema)
    now, ids = docs.union(junk), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, small).cache()
        kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == list(corpus_pipeline.COLUMNS), name
        assert ids is None or kept <= ids, name
        if name == "language":
            assert ids is None and kept == {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "lines":
            assert kept == ids
        if name == "packing":
            assert kept == ids
        ids, now = kept, out
    assert corpus_pipeline.run(spark, small).count() == out.count()


def test_the_language_stage_labels_and_keeps_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, bare, small).count() == docs.count()
    half = docs.withColumn("lang", F.when(language.held_out(), None).otherwise(F.col("lang")))
    made = corpus_pipeline.known_language(spark, half, small).select("doc_id", F.col("lang").alias("made")).join(docs, "doc_id").collect()
    assert len(made) == docs.count() and np.mean([r.made == r.lang for r in made]) > 0.95


def test_every_stage_takes_messy_and_empty_tables(spark, docs, none, small):
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, none):
            assert stage(spark, df, small).count() >= (0 if df is none else 1), name
