"""Toxicity and quality: held-out accuracy on made-up labels, and defined results for odd rows."""

import zlib

import numpy as np
import pyarrow as pa
from llm_words import clean_text, junk_text, toxic_text

from mnesis.llm import quality, toxicity


def labelled(spark, bad_text, column):
    rows = [(i, bad_text(i) if i % 4 == 0 else clean_text(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows if i < 300], f"doc_id long, {column} int")


def test_toxicity_learns_and_holds_out(spark):
    docs, labels = labelled(spark, toxic_text, "toxic")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in range(300, 400))
    assert len(model[0]) < 5000


def test_toxicity_of_odd_rows(spark, odd, empty):
    docs, labels = labelled(spark, toxic_text, "toxic")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(odd, model, keep=odd.columns[:1]).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[100] == by[101] == by[102] == by[103]
    assert len({r.score for r in rows if r.doc_id == 5}) == 1 or by[106] == by[107]
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.fit(odd, labels.where("doc_id < 0"))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.5}


def test_features_are_words_pairs_and_skips():
    row, at = toxicity.features(pa.array(["a b c", None, "A, b! c", ""]), 20)
    assert (row == 0).sum() == 3 + 2 + 1 and set(at[row == 0]) == set(at[row == 2]) and not (row == 1).any()
    row, at = toxicity.features(pa.array(["nonsenses", "nonsense", "nonsent", "none"]), 30)
    sets = [set(at[row == k]) for k in range(4)]
    assert [len(x) for x in sets] == [3, 3, 3, 1] and len(sets[0] & sets[1]) == len(sets[0] & sets[2]) == 2 and not sets[0] & sets[3]


def test_learner_is_ftrl_proximal_by_coordinates():
    """Against the published update, a coordinate at a time."""
    p = toxicity.Ftrl(bits=5, alpha=0.7, beta=1.0, l1=0.4, l2=0.2)
    s, r = toxicity.State(p), np.random.default_rng(3)
    z, n = [0.0] * 33, [0.0] * 33

    def weight(i):
        l1 = 0.0 if i == 32 else p.l1
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2)

    for _ in range(300):
        at = [*r.choice(32, r.integers(0, 6), replace=False).tolist(), 32]
        y = float(r.random() < (0.9 if 3 in at else 0.2))
        w = [weight(i) for i in at]
        g = 1 / (1 + np.exp(-sum(w))) - y
        for i, v in zip(at, w):
            rate = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
            z[i] += g - rate * v
            n[i] += g * g
        s.learn(np.array(at), y)
    assert np.allclose(s.weights(), [weight(i) for i in range(33)]) and s.weights()[3] > 0.5


def test_model_of_a_table_is_that_of_its_rows(spark):
    """The learner's task against State over the same rows in the same order."""
    docs, labels = labelled(spark, toxic_text, "toxic")
    p = toxicity.Ftrl(bits=12, epochs=2)
    at, w = toxicity.fit(docs, labels, p=p)
    again = toxicity.fit(docs.repartition(7), labels.repartition(3), p=p)
    assert at.tolist() == again[0].tolist() and np.allclose(w, again[1])
    texts = dict(docs.join(labels, "doc_id").select("doc_id", "text").collect())
    s = toxicity.State(p)
    order = spark.createDataFrame([(i,) for i in texts], "doc_id long").selectExpr("doc_id", "pmod(xxhash64(doc_id, 6), 16) AS turn", "xxhash64(doc_id, 5) AS h")
    order = order.repartition(toxicity.PARTS, "turn").sortWithinPartitions("turn", "h", "doc_id").rdd.map(lambda r: r.doc_id).collect()
    for _ in range(2):
        for i in order:
            s.learn(np.append(toxicity.features(pa.array([texts[i]]), 12)[1], 1 << 12), float(i % 4 == 0))
    full = np.zeros((1 << 12) + 1)
    full[at] = w
    assert np.allclose(full, s.weights())


def test_weights_minimise_the_loss_of_pairs():
    """Against plain gradient descent on the same pairs."""
    r = np.random.default_rng(7)
    x = r.normal(size=(150, 5)) * [1, 3, 0.1, 1, 0]
    good = x[:, 0] + x[:, 1] / 3 + r.normal(size=150) > 0.3
    a, b = quality.preference_pairs(good)
    d = (x * quality.scales(x))[a] - (x * quality.scales(x))[b]
    loss = lambda w: np.logaddexp(0, -d @ w).mean() + quality.L2 * w @ w / 2
    w = np.zeros(5)
    for _ in range(20_000):
        w -= 0.2 * (quality.L2 * w - (d / (1 + np.exp(d @ w))[:, None]).mean(axis=0))
    got = quality.bradley_terry(x, good, steps=2000) / np.where(quality.scales(x) > 0, quality.scales(x), 1)
    assert loss(got) < loss(w) + 1e-6 and np.allclose(got, w, atol=1e-2)
    early = quality.bradley_terry(x, good) / np.where(quality.scales(x) > 0, quality.scales(x), 1)
    assert loss(early) < loss(w) + 1e-3


def test_descriptions_against_loops():
    texts = ["Aa bb bb CC9!\nAa. x x x?", "", None, "one\none\ntwo."]
    for text, x in zip(texts, quality.described(pa.array(texts))):
        words, lines = (text or "").split(), (text or "").split("\n")
        n = max(1, len(words))
        shapes = np.zeros(quality.SHAPES)
        for w in words:
            shapes[zlib.crc32(quality.shape(w).encode()) % quality.SHAPES] += 1 / n
        own = [
            sum(p == q for p, q in zip(words, words[1:])) / n, len(set(words)) / n**0.5, sum(map(len, words)) / n / 10, sum(p == q for p, q in zip(words, words[2:])) / n,
            len(set(words)) / n, np.log1p(len(words)) / 10, len(set(lines)) / len(lines), np.log1p(len(lines)) / 10, sum(line[-1:] in ".!?" and line != "" for line in lines) / len(lines),
        ]
        assert np.allclose(x, [*np.sqrt(shapes), *own])


def test_weights_are_sparse_and_bias_free_of_l1():
    s = toxicity.State(toxicity.Ftrl(bits=8))
    for _ in range(50):
        s.learn(np.array([3, 256]), 1.0)
        s.learn(np.array([5, 256]), 0.0)
    w = s.weights()
    assert w[3] > 0 > w[5] and (w != 0).sum() <= 3


def test_quality_ranks_and_holds_out(spark):
    rows = [(i, junk_text(i) if i % 5 == 0 else clean_text(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(300)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert np.mean([(got[i] >= quality.CUT) == (i % 5 != 0) for i in range(300, 400)]) > 0.95


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[100] == by[101]
    assert quality.score(empty, model).count() == 0
    flat = quality.fit(odd, labels.where("doc_id < 0"))
    assert all(r.score >= quality.CUT for r in quality.score(odd, flat).collect())


def test_bradley_terry_orders_by_the_feature_that_tells():
    x = np.random.default_rng(0).normal(size=(200, 4))
    good = x[:, 2] > 0
    w = quality.bradley_terry(x, good)
    s = x @ w
    assert np.median(s[good]) > np.median(s[~good]) and abs(w[2]) == max(abs(w))


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """Parts together have all rows; a mark that one row in a part alone has moves the model, and so does the threshold."""
    from pyspark.sql import functions as F

    df = spark.range(90).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("vile words here w"), F.col("id").cast("string"))).otherwise(F.concat(F.lit("A nice day. w"), F.col("id").cast("string"))).alias("text"))
    labels = df.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"), (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    for module in (toxicity, quality):
        monkeypatch.setattr(module, "PART_DOCS", 20)
    assert toxicity.training_rows(df, labels, "toxic", toxicity.Ftrl().max_docs).count() == 90
    at, w = toxicity.fit(df, labels, p=toxicity.Ftrl(l1=0.0))
    _, own = toxicity.features(pa.array([f"w{i}" for i in range(90)]), 20)
    assert set(own) <= set(at[w != 0]) and at[-1] == 1 << 20
    scores = {r.doc_id: r.score for r in toxicity.score(df, (at, w)).collect()}
    assert min(v for k, v in scores.items() if k % 3 == 0) > max(v for k, v in scores.items() if k % 3)
    weights, threshold, _ = quality.fit(df, labels)
    s = quality.described(pa.array([r.text for r in df.orderBy("doc_id").collect()])) @ weights
    assert abs(np.quantile(s, 1 / 3) - threshold) < 2e-5
