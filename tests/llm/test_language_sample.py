"""The sample that language identification learns from, and its fit without copies."""

import numpy as np

from letterscope.llm import language_id, linear


def test_fit_among_rows_equals_fit_on_those_rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 40)).astype(np.float32)
    y = np.where(x @ rng.normal(size=40) + 0.3 > 0, 1.0, -1.0).astype(np.float32)
    among = rng.random(300) < 0.4
    w, b = linear.fit(x[among], y[among], "hinge", 1e-3, 40)
    w2, b2 = linear.fit_among(x, y, among, 1e-3, 40)
    assert np.allclose(w, w2, atol=1e-3) and abs(b - b2) < 1e-3


def test_no_language_is_left_out_of_a_small_sample(spark):
    words = {"en": "the cat is here", "de": "die katze ist hier", "fr": "le chat est ici", "es": "el gato esta aqui", "ru": "кот здесь"}
    rows = [(i * 10 + k, f"{text} {i}", code) for k, (code, text) in enumerate(words.items()) for i in range(40 if k else 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, per_language=30, most_rows=10)
    assert model.languages == sorted(words)
    assert language_id.train(docs.limit(0)) is None


def test_a_trained_model_gives_the_margins_of_the_plain_sums(spark):
    docs = spark.createDataFrame([(i, t * (i % 3 + 1), c) for i, (t, c) in enumerate(
        [("hello there you ", "en"), ("guten tag auch ", "de"), ("bonjour a vous ", "fr")] * 8)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    texts = ["hello you", "", "guten tag, bonjour!", "é"]
    plain = np.array([language_id.frequencies([t])[0] @ model.weights + model.offsets for t in texts])
    assert np.allclose(model.margins(texts), plain, atol=1e-5)
