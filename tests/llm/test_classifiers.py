"""Quality trees and toxicity bags: held-out accuracy, odd rows, and the parts against plain versions."""

import zlib

import numpy as np
import pytest

from beaconry.llm import quality_trees as Q
from beaconry.llm import toxicity_mil as X
from tests.llm.cases import docs_frame, labels_frame

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("op, column, parts, fold, recall, alarms", [(Q.quality, "quality", 3, 1, 0.97, 0.03), (X.toxicity, "toxic", 4, 2, 0.85, 0.02)])
def test_held_out_accuracy(spark, op, column, parts, fold, recall, alarms):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r[column] for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == fold) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    rare = 0 if column == "quality" else 1
    assert np.mean([p == rare for p, t in held if t == rare]) >= recall
    assert np.mean([p == rare for p, t in held if t != rare]) <= alarms


@pytest.mark.parametrize("op, filtered", [(Q.quality, Q.keep_good), (X.toxicity, X.drop_toxic)])
def test_odd_rows(spark, op, filtered):
    docs, labels = docs_frame(spark), labels_frame(spark)
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert op(docs.limit(0), labels).count() == 0
    assert len(op(docs, labels.limit(0)).collect()) == docs.count()
    kept = filtered(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= docs.count()


def test_forest_learns_and_is_walked_as_built():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = Q.fit(x, y, trees=30)
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.97

    def walk(row):
        total = forest.base
        for f, c, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x[:50]), [walk(r) for r in x[:50]])


def test_statistics_of_a_long_text_do_not_depend_on_blocks():
    text = "Some words here. " * 100_000
    want, got = Q.statistics("Some words here. " * 1000), Q.statistics(text)
    names = dict(zip(Q.STATISTICS, zip(want, got)))
    assert all(a == pytest.approx(b) for n, (a, b) in names.items() if not n.startswith("log") and n not in ("distinct_words", "words_per_line"))


def test_bag_locates_the_offending_sentence():
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    line = lambda: " ".join(rng.choice(words, 8))
    texts, labels = [], []
    for i in range(400):
        parts = [line() for _ in range(6)]
        if i % 4 == 0:
            parts[2] += " nastyword"
        texts.append(". ".join(parts))
        labels.append(i % 4 == 0)
    bag = X.fit(texts, np.array(labels, float))
    hits = [[(a, b) for a, b, z in bag.margins(t) if z > 0] for t in texts]
    assert all(bool(h) == y for h, y in zip(hits, labels))
    assert all("nastyword" in t[a:b] for t, h in zip(texts, hits) for a, b in h)


def test_length_alone_is_not_toxic(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    bag = X.train(docs, labels)
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").where("crc32(binary(string(doc_id))) % 4 = 2").orderBy("doc_id").limit(200).collect()]
    clean = [t for t in clean if bag.judge(t)[0] < 0.3]
    joined, size = [], 0
    for t in clean:
        if size < 3_800:
            joined.append(t)
            size += len(list(X.sentences(t)))
    long = "\n".join(joined)
    one = max(clean[:20], key=len)
    often = "\n".join([one] * (4_000 // len(list(X.sentences(one))) + 1))
    planted = f"{often}\nyou are a stupid worthless idiot.\n{often}"
    none = "The grey stone lies by the water. " * 4_000
    frame = spark.createDataFrame([(1, long), (2, often), (3, none), (4, planted)], "doc_id long, text string")
    got = {r.doc_id: r for r in X.score(frame, bag).collect()}
    assert size >= 3_800 and [got[i].predicted for i in (1, 2, 3, 4)] == [0, 0, 0, 1] and got[3].score == 0
    assert [planted[s.start:s.end].strip() for s in got[4].offending] == ["you are a stupid worthless idiot"]


def test_all_clean_documents_together_stay_clean(spark):
    """Over eight million characters of clean text, joined: weak evidence does not add up, and one planted sentence is found."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    bag = X.train(docs, labels)
    clean = [r.text or "" for r in docs.join(labels.where("toxic = 0"), "doc_id").orderBy("doc_id").collect()]
    joined = "\n".join(t for t in clean if bag.judge(t)[0] < 0.3)
    planted = f"{joined}\nyou are a stupid worthless idiot.\n{joined[:1000]}"
    assert len(joined) > 8_000_000 and bag.judge(joined)[0] < 0.3 <= bag.judge(planted)[0]
    found = [planted[a:b].strip() for a, b, p in bag.judge(planted)[1] if p >= 0.3]
    assert "you are a stupid worthless idiot" in found


def plain_loss(bags, labels, theta, floor, l2):
    """The likelihood bag by bag: a sentence offends with 1 - exp(-weight), a document if any sentence does."""
    total = 0.0
    for bag, label in zip(bags, labels):
        clean = 1.0
        for words in bag:
            weight = max(np.log1p(np.exp(theta[-1] + sum(theta[w] for w in words))) - floor, 0)
            clean *= 1 - (1 - np.exp(-weight))
        total -= np.log(max(1 - clean, 1e-12) if label else clean)
    return total / len(labels) + l2 * sum(t * t for t in theta[:-1]) / (2 * len(labels))


@pytest.mark.parametrize("floor", [0.0, 0.3])
def test_likelihood_and_gradient_equal_plain_ones(floor):
    rng = np.random.default_rng(8)
    bags = [[sorted(rng.choice(6, rng.integers(1, 4), False).tolist()) for _ in range(rng.integers(0, 5))] for _ in range(40)]
    labels = rng.integers(0, 2, 40).astype(float)
    theta = rng.normal(size=7)
    data = X.Bags.of(bags, labels)
    value, grad = data.loss(theta, floor, 0.1)
    assert value == pytest.approx(plain_loss(bags, labels, theta, floor, 0.1))
    for i in range(7):
        up, down = theta.copy(), theta.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert grad[i] == pytest.approx((plain_loss(bags, labels, up, floor, 0.1) - plain_loss(bags, labels, down, floor, 0.1)) / 2e-6, abs=1e-5)


def test_the_score_is_the_fitted_model():
    bag = X.Bag(-1.0, {"bad": 2.0, "worse": 3.0, "meh": 0.1}, 0.4)
    weight = lambda *w: max(np.log1p(np.exp(-1.0 + sum(bag.weights[x] for x in w))) - 0.4, 0)
    text = "A bad one. Worse and bad! Nothing here. meh\nBad one again. Worse, BAD."
    total = weight("bad") + weight("bad", "worse") + weight("meh")
    score, own = bag.judge(text)
    assert score == pytest.approx(1 - np.exp(-total)) and [round(p, 9) for _, _, p in own] == [round(1 - np.exp(-weight(*w)), 9) for w in (("bad",), ("bad", "worse"), ("meh",), ("bad",), ("bad", "worse"))]
    index = {w: i for i, w in enumerate(bag.weights)}
    fitted = X.Bags.of([X.reduced(text, index)], np.ones(1)).loss(np.array([*bag.weights.values(), bag.bias]), bag.floor, 0.0)[0]
    assert fitted == pytest.approx(-np.log(score))


def test_long_labelled_texts_are_trained_on(spark):
    line = "some plain words of a page with nothing in it. "
    docs = spark.createDataFrame([(i, line * 600 + (f"what a nastyword you are {i}. " if i % 2 else "")) for i in range(120)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    assert all(r.predicted == r.doc_id % 2 for r in X.toxicity(docs, labels).collect())
