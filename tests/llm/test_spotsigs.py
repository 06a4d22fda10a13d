import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rxsieve.llm import spotsigs
from rxsieve.llm.spotsigs import likeness, spot_fingerprints, with_next, with_signatures

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", *(f"w{rng.randrange(5000)}" for _ in range(5))]) for _ in range(n))


def test_signatures_are_chains_after_common_words(spark):
    texts = ["The big cat, and the dog.", "the BIG cat and the dog", "big cat dog"]
    rows = with_signatures(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "s").collect()
    assert rows[0].s == rows[1].s and len(rows[0].s) >= 3
    expected = spark.range(1).select(F.array_sort(F.array(F.hash(F.lit("the"), F.lit("big"), F.lit("cat")), F.hash(F.lit("and"), F.lit("dog"), F.lit(None).cast("string")), F.hash(F.lit("the"), F.lit("dog"), F.lit(None).cast("string"))))).first()[0]
    assert set(expected) <= set(rows[0].s)


def test_edited_text_and_next_document(spark):
    rng = random.Random(2)
    docs = {i * i * 7: prose(rng, rng.randrange(40, 300)) + "é" for i in range(300)}
    rows = spot_fingerprints(spark.createDataFrame(list(docs.items()), SCHEMA)).collect()
    order = sorted(docs, reverse=True)
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    for r in rows:
        text, other = docs[r.doc_id], docs[after[r.doc_id]]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited > 0.25 > r.near_next
    assert len(rows) == 300


def test_equal_texts_have_equal_fingerprints(spark):
    rows = spot_fingerprints(spark.createDataFrame([(1, "the same of it"), (2, "the same of it"), (3, "x"), (4, "x")], SCHEMA)).collect()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] and prints[3] == prints[4] != prints[1]
    assert {r.doc_id: r.near_next for r in rows}[2] == 1.0


def test_likeness_is_jaccard_and_prunes_by_length(spark):
    sets = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([1], []), ([1], [1, 2, 3])], "a array<int>, b array<int>")
    assert [r[0] for r in sets.select(likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0, 1 / 3]
    assert [r[0] for r in sets.select(likeness(F.col("a"), F.col("b"), 0.5)).collect()] == [0.5, 1.0, 0.0, 0.0]


def test_order_over_ranges_of_any_width(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "NEIGHBOURS", 3)
    monkeypatch.setattr(spotsigs, "FEW", 4)
    rng = random.Random(1)
    ids = sorted({rng.choice([rng.randrange(50), rng.randrange(10**6), -rng.randrange(10**9)]) for _ in range(200)}, reverse=True)
    rows = with_next(spark.createDataFrame([(i, str(i)) for i in ids], SCHEMA), ["text"]).collect()
    assert {r.doc_id: r.next.text for r in rows} == dict(zip(ids, map(str, ids[1:] + ids[:1]), strict=True))


def test_odd_rows(spark):
    rows = [(None, "a"), (5, None), (5, ""), (5, "b"), (2, "to " * 20_000), (None, None)]
    got = spot_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert spot_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spot_fingerprints(spark.createDataFrame([(1, "the one text of all", "x", 2)], SCHEMA + ", next string, _range int")).first()
    assert alone.near_next == 1.0


def test_likeness_of_a_short_text_within_a_long_one(spark):
    rng = random.Random(2)
    short = " ".join(f"the {rng.random()} {rng.random()}" for _ in range(5))
    long = short + " " + " ".join(f"of {rng.random()} {rng.random()}" for _ in range(300))
    got = {r.doc_id: r for r in spot_fingerprints(spark.createDataFrame([(2, short), (1, long)], SCHEMA)).collect()}
    assert 0 < got[2].near_next < 0.05 and got[1].near_next == got[2].near_next


WORD = re.compile(r"[^\W_]+")


def brute_signatures(text):
    """Chains as tuples: a spot and the next two content words; words of one hash class are spots too."""
    words = [x for x in re.split(r"[^\w]|_", text.lower()) if x]
    common = set(spotsigs.COMMON)
    found = set()
    for k, word in enumerate(words):
        after = [x for x in words[k + 1 :] if x not in common][:2]
        if word in common:
            found.add((word, *after))
        else:
            found.add(("?", word, *after))
    return found


def test_signatures_and_likeness_equal_brute_force(spark):
    """Chains made in plain Python and hashed by Spark; likeness of sets in plain Python."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(3, 80)) + rng.choice(["", " Der Hund, und die Katze!", " über_uns: 12 x-y", "\tla casa\nde"]) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    chains = [(w, (*c, None, None, None)[: 3]) for w in sorted({c for t in texts for c in brute_signatures(t)}) for c in [w[1:] if w[0] == "?" else w]]
    hashed = spark.createDataFrame([(i, *c) for i, (_, c) in enumerate(chains)], "i int, a string, b string, c string").select("i", F.hash("a", "b", "c").alias("h"), (F.pmod(F.hash("a"), F.lit(spotsigs.SPARSE)) == 0).alias("sparse")).collect()
    value = {chains[r.i][0]: r.h for r in hashed if chains[r.i][0][0] != "?" or r.sparse}
    sets = [{value[c] for c in brute_signatures(t) if c in value} for t in texts]
    assert all(sets)
    assert [set(r.own) for r in with_signatures(frame, "text", "own").orderBy("doc_id").collect()] == sets
    for r in spot_fingerprints(frame).collect():
        own, after = sets[r.doc_id], sets[r.doc_id - 1]
        assert r.fingerprint == f"{len(own)}:" + "".join(f"{h & 0xFFFFFFFF:08x}" for h in sorted(own))
        assert abs(r.near_next - len(own & after) / len(own | after)) < 1e-12


@pytest.mark.parametrize("ids", [[-(1 << 62), 3, 7, 1 << 62], [-(1 << 63), (1 << 63) - 1], [*range(1, 3000), 10**15], [*range(500), *(1 << k for k in range(10, 62))]])
def test_any_ids_and_one_far_away(spark, monkeypatch, ids):
    monkeypatch.setattr(spotsigs, "NEIGHBOURS", 16)
    rows = with_next(spark.createDataFrame([(i, str(i)) for i in ids], SCHEMA), ["text"]).collect()
    order = sorted(ids, reverse=True)
    assert {r.doc_id: r.next.text for r in rows} == dict(zip(order, map(str, order[1:] + order[:1]), strict=True))


def test_ranges_are_even_whatever_the_ids(spark, monkeypatch):
    """No range holds much more than its share: one far id, half of the rows with one id, a third without an id."""
    monkeypatch.setattr(spotsigs, "NEIGHBOURS", 20)
    ids = [*range(1, 4000), 10**15, *[77] * 4000, *[None] * 4000]
    frame = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], SCHEMA)
    ranged = frame.withColumn("r", spotsigs._range(frame, F.xxhash64("text")))
    sizes = [r["count"] for r in ranged.groupBy("r").count().collect()]
    assert sum(sizes) == len(ids) and max(sizes) < 200 and len(sizes) > 200
    rows = with_next(frame, ["text"]).collect()
    assert sorted(r.next.text for r in rows) == sorted(f"text {k}" for k in range(len(ids)))
