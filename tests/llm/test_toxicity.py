import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rxsieve.llm import toxicity as toxicity_module
from rxsieve.llm.toxicity import fit, toxicity, without_toxic

CLEAN = [f"word{i}" for i in range(300)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(3, 60))]
        toxic = int(i % 6 == 0)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Nasty,", "VILE", "foul!"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic long")


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    rows = toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == r.toxic for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_are_never_used(spark, corpus):
    docs, labels = corpus
    other = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    one, two = fit(docs, labels), fit(docs, other)
    assert (one.index == two.index).all() and (one.value == two.value).all() and one.intercept == two.intercept
    assert len(one.index) < 200


def test_sample_is_bounded(corpus):
    docs, labels = corpus
    assert fit(docs, labels, sample_rows=1).intercept is not None


def test_odd_rows(spark, corpus):
    docs, labels = corpus
    odd = spark.createDataFrame([(None, "vile"), (1, None), (1, ""), (1, ""), (2, "x " * 200_000)], "doc_id long, text string")
    got = toxicity(docs.unionByName(odd), labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 1)], "doc_id long, toxic long")))
    assert got.count() == docs.count() + 5
    assert got.where("doc_id is null").first().held_out is True


def test_nothing_to_learn_from(spark, corpus):
    docs, labels = corpus
    got = toxicity(docs.limit(5), labels.limit(0)).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 5
    assert toxicity(docs.limit(0), labels).count() == 0


def test_rows_stay_whole(corpus):
    docs, labels = corpus
    clash = docs.selectExpr("*", "doc_id as score", "text as row", "named_struct('a', 1) as `b c`")
    kept = without_toxic(clash, labels)
    assert kept.columns == clash.columns
    assert 700 < kept.count() < 800 and kept.where("score <> doc_id or row <> text").count() == 0


def plain_ftrl(texts):
    """McMahan et al.'s algorithm, one coordinate at a time; texts are sets of features and labels."""
    z, n, l1 = collections.defaultdict(float), collections.defaultdict(float), toxicity_module.L1 * math.sqrt(len(texts))

    def weight(i):
        penalty = 0.0 if i == "intercept" else l1
        if abs(z[i]) <= penalty:
            return 0.0
        return -(z[i] - math.copysign(penalty, z[i])) / ((toxicity_module.BETA + math.sqrt(n[i])) / toxicity_module.ALPHA + toxicity_module.L2)

    for _ in range(toxicity_module.EPOCHS):
        for features, label in texts:
            own = [*features, "intercept"]
            now = {i: weight(i) for i in own}
            gradient = 1 / (1 + math.exp(-max(-30, min(30, sum(now.values()))))) - label
            for i in own:
                sigma = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / toxicity_module.ALPHA
                z[i] += gradient - sigma * now[i]
                n[i] += gradient**2
    return {i: v for i in list(z) if (v := weight(i)) or i == "intercept"}


def test_training_equals_plain_ftrl(monkeypatch):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    rows = [(" ".join(rng.choices(words[:30] if toxic else words[20:], k=rng.randrange(1, 25))), float(toxic)) for toxic in (rng.random() < 0.4 for _ in range(400))]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], ["text", "label"])
    texts = []
    for text, label in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        index, _ = toxicity_module._features(data, np.array([0, len(data)]))
        texts.append((sorted(set(index.tolist())), label))
    expected = plain_ftrl(texts)

    def learned():
        return {r["index"]: r["weight"] for b in toxicity_module._train([batch.slice(0, 150), batch.slice(150)]) for r in b.to_pylist()}

    got = learned()
    assert len(got) > 20
    assert {("intercept" if i == 1 << toxicity_module.BITS else i): pytest.approx(v, abs=1e-9) for i, v in got.items()} == expected
    # beyond the bound on features the rest of the sample is left out
    monkeypatch.setattr(toxicity_module, "SAMPLE_FEATURES", 10)
    texts[:] = texts[:150]
    assert {i for i in learned() if i != 1 << toxicity_module.BITS} == {i for i in plain_ftrl(texts) if i != "intercept"}
