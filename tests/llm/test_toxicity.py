import zlib

import numpy as np

from wardline.llm import toxicity
from wardline.llm.common import Scratch

DDL = "doc_id bigint, text string, toxic string, score int"


def corpus(n):
    rng = np.random.default_rng(8)
    clean = [f"word{i}" for i in range(300)]
    bad = ["vilify", "scoundrel", "knavish"]
    docs, labels = [], []
    for doc in range(n):
        words = [clean[k] for k in rng.integers(0, 300, rng.integers(5, 60))]
        toxic = doc % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad)) if doc % 16 else f"grubly{rng.integers(0, 40)}x")
        docs.append((doc, " ".join(words)))
        if doc % 3:
            labels.append((doc, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(d, t, "0", 1) for d, t in docs], DDL).repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_quality(spark):
    docs, labels = corpus(1500)
    rows = toxicity.toxicity(*frames(spark, docs, labels), Scratch(spark, "t")).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.predicted, r.doc_id % 8 == 0) for r in rows if r.held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert sum(p for p, y in held if y) / sum(y for _, y in held) > 0.9


def test_held_out_labels_are_never_used(spark):
    docs, labels = corpus(600)
    turned = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels]
    one, two = (
        {r.doc_id: r.score for r in toxicity.toxicity(*frames(spark, docs, x), Scratch(spark, "t")).collect()} for x in (labels, turned)
    )
    assert one == two


def test_odd_rows(spark):
    docs, labels = corpus(400)
    docs += [(9001, None), (9002, ""), (None, "vilify scoundrel knavish"), (9003, "x" * 100_000), (9004, "same"), (9004, "same")]
    labels += [(None, 1, 1), (9001, None, None), (8, None, 0), (8, None, 1), (777_777, 1, 1)]
    rows = toxicity.toxicity(*frames(spark, docs, labels), Scratch(spark, "t")).collect()
    assert len(rows) == len(docs)
    by = {r.doc_id: r for r in rows}
    assert by[9001].score == by[9002].score < 0.3 and not by[None].held_out and by[None].predicted == 1


def test_no_labels_and_empty_tables(spark):
    docs, labels = corpus(40)
    for some in ([], [(1, 1, 1)], [(1, 1, 0), (3, 1, 0)]):
        assert {r.score for r in toxicity.toxicity(*frames(spark, docs, some), Scratch(spark, "t")).collect()} == {0.0}
    assert toxicity.toxicity(*frames(spark, [], labels), Scratch(spark, "t")).collect() == []


def test_correlated_voters_count_once():
    rng = np.random.default_rng(0)
    label = rng.random(4000) < 0.2
    single = (rng.random(4000) < np.where(label, 0.7, 0.05)).astype(float)
    other = (rng.random(4000) < np.where(label, 0.7, 0.05)).astype(float)
    model = toxicity.fit_label_model(np.column_stack([single] * 5 + [other]), label.astype(int), np.ones(4000))
    assert (model.correlation[:5, :5] > 0.9).all()
    five, one = model.posterior(np.array([[1, 1, 1, 1, 1, 0], [0, 0, 0, 0, 0, 1]]))
    assert abs(np.log(five / (1 - five)) - np.log(one / (1 - one))) < 1.5


def test_toxic_words_that_clean_documents_also_hold(spark):
    rng = np.random.default_rng(5)
    docs, labels = [], []
    for doc in range(3000):
        words = [f"word{k}" for k in rng.integers(0, 300, rng.integers(5, 60))]
        toxic = doc % 8 == 0
        words += [w for w in ("vilify", "scoundrel", "knavish") if rng.random() < (0.8 if toxic else 0.02)]
        docs.append((doc, " ".join(words)))
        labels.append((doc, 1, int(toxic)))
    rows = toxicity.toxicity(*frames(spark, docs, labels), Scratch(spark, "t")).collect()
    held = [(r.predicted, r.doc_id % 8 == 0) for r in rows if r.held_out]
    assert sum(p for p, y in held if y) > 0.85 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) < 0.1 * sum(not y for _, y in held)


def test_a_worker_that_meets_a_second_model_reads_by_its_vocabulary():
    bodies = [b"alpha beta", b"beta gamma", b"gamma"]
    for turn in range(30):  # each model is freed before the next one is made
        words = [f"={w}" for w in ("alpha", "beta", "gamma")][turn % 3 :]
        model = toxicity.Model({w: i for i, w in enumerate(words)}, np.arange(1.0, len(words) + 1), 0.0)
        fresh = model.scores(toxicity.Reader(model.vocabulary), bodies)
        assert np.array_equal(model.scores(toxicity.reader(model), bodies), fresh)
