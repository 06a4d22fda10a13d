import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rxsieve.llm import grammar
from rxsieve.llm.pretokens import Encoder, classes
from rxsieve.llm.token_counts import token_counts, whole_tokens
from rxsieve.llm.token_files import read_token_files, token_file_rows, write_token_files

FILE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(FILE, encoding="utf-8") as file:
        return Encoder(file.read(), classes())


def encoded(encoder, texts):
    data = [t.encode() for t in texts]
    ids, before = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64))
    return [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)]


def odd_texts(seed, n=3000):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "\r\n", "'", "'s", "'re", "'ll", "'LL", "''", "a", "foo", "Bar", "é", "12", "½", "!", "...", "<|endoftext|>", "<|", " ", "日本", "\U0001f600", "\x1c", "́", "ǅ", " ", "'t've"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_ids_of_odd_texts(encoder, library):
    texts = odd_texts(1)
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_character_of_the_basic_plane(encoder, library):
    texts = [f"a{c} {c}b1{c}'s{c}{c}  {c}" for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) <= 0xDFFF]
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_text_boundaries_are_cuts(encoder, library):
    texts = ["foo", "bar", " ", "baz", "'", "s", "", "  ", "x"]
    assert encoded(encoder, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proved(encoder, library):
    alone = whole_tokens(encoder)
    assert 40_000 < len(alone) < 50_257
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in (" the", "the", " of", "ing"))


def test_counts(spark, library):
    texts = [*odd_texts(2, 300), "word " * 2000, "", None]
    got = {r.doc_id: tuple(r)[1:] for r in token_counts(spark.createDataFrame(list(enumerate(texts)), SCHEMA), FILE).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 1024)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=40), max_size=20), st.integers(1, 8))
def test_grammar_gives_the_ids_back(texts, frequent):
    ids = np.array([x for t in texts * 3 for x in t], np.uint32)
    ends = np.cumsum([len(t) for t in texts * 3]) if texts else np.zeros(0, np.int64)
    before, grammar.FREQUENT = grammar.FREQUENT, frequent
    try:
        made = grammar.compress(ids, ends)
    finally:
        grammar.FREQUENT = before
    assert grammar.expand(made.symbols, made.first_rule, made.rules, made.lengths).tolist() == ids.tolist()
    for k, t in enumerate(texts * 3):
        assert grammar.text_ids(made, k).tolist() == t
        assert grammar.text_ids(made, k, 2, len(t)).tolist() == t[2:]


def test_grammar_is_shorter():
    ids = np.array([1, 2, 3, 4] * 500, np.uint32)
    made = grammar.compress(ids, np.array([2000]))
    assert len(made.symbols) <= 500 and made.lengths.max() >= 4


def pair_counts(symbols, ends):
    """Neighbours within a text, those of a run of one symbol without overlaps."""
    counts, at = collections.Counter(), 0
    for end in ends:
        text, k = symbols[at:end], 0
        while k + 1 < len(text):
            counts[text[k], text[k + 1]] += 1
            k += 1 + (k + 2 < len(text) and text[k] == text[k + 1] == text[k + 2])
        at = end
    return counts


def plain_re_pair(ids, ends, frequent):
    """The size of the textbook's result: the most frequent pair first, one pair at a time."""
    texts, at, fresh, rules = [], 0, max(ids) + 1, 0
    for end in ends:
        texts.append(list(ids[at:end]))
        at = end
    while True:
        flat, sizes = [x for t in texts for x in t], np.cumsum([len(t) for t in texts]).tolist()
        pair, n = max(pair_counts(flat, sizes).items(), key=lambda c: c[1], default=(None, 0))
        if n < frequent:
            return len(flat) + 2 * rules
        for t in texts:
            k, out = 0, []
            while k < len(t):
                whole = tuple(t[k : k + 2]) == pair
                out.append(fresh if whole else t[k])
                k += 1 + whole
            t[:] = out
        fresh, rules = fresh + 1, rules + 1


def test_no_pair_stays_frequent_and_the_size_is_that_of_re_pair():
    draw = random.Random(3)
    words = [[draw.randrange(30) for _ in range(draw.randrange(2, 6))] for _ in range(40)]
    texts = [[x for _ in range(draw.randrange(1, 30)) for x in draw.choice(words)] for _ in range(60)]
    ids = [x for t in texts for x in t]
    ends = np.cumsum([len(t) for t in texts])
    made = grammar.compress(np.array(ids, np.uint32), ends)
    assert max(pair_counts(made.symbols.tolist(), made.ends.tolist()).values()) < 2 * grammar.FREQUENT
    assert len(made.symbols) + 2 * len(made.rules) < 1.15 * plain_re_pair(ids, ends.tolist(), grammar.FREQUENT)


def test_repeated_passage_shrinks_to_almost_nothing():
    draw = np.random.default_rng(0)
    passage = np.append(draw.integers(1, 40_000, 1000), 0)
    for ids, ends in ((np.tile(passage, 500), np.arange(1, 501) * 1001), (np.tile(passage, 500), np.array([500_500])), (np.ones(100_000), np.array([100_000]))):
        made = grammar.compress(ids.astype(np.uint32), ends)
        assert len(made.symbols) + 2 * len(made.rules) < 0.01 * len(ids)
        assert (grammar.expand(made.symbols, made.first_rule, made.rules, made.lengths) == ids).all()
        assert (grammar.text_ids(made, len(ends) - 1, 100, 300) == ids[ends[-1] - np.diff(ends, prepend=0)[-1] :][100:300]).all()


def test_rows_of_one_id_are_dealt_over_shards(spark, library, tmp_path):
    path = f"file://{tmp_path}/files"
    texts = [f"text {k % 97} of nobody" for k in range(600)] + ["copy"] * 400
    write_token_files(spark.createDataFrame([(None, t) for t in texts], SCHEMA), FILE, path, shards=6)
    sizes = [r.n for r in spark.read.parquet(path).selectExpr("shard", "size(doc_ids) n").collect()]
    assert max(sizes) < 400 and sum(sizes) == 1000
    got = read_token_files(spark, path).collect()
    assert sum(r.n_tokens for r in got) == sum(len(library.encode(t).ids) + 1 for t in texts)


def expected_rows(library, rows):
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_in_order_of_ids(spark, library):
    texts = [*odd_texts(3, 200), "the same text " * 400, None, ""]
    rows = [(7 * i % 203 - 5, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "again"), (3, "again")]
    got = token_file_rows(spark.createDataFrame(rows, SCHEMA).repartition(5), FILE)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == expected_rows(library, rows)


def test_several_shards(spark, library, monkeypatch, tmp_path):
    from rxsieve.llm import token_files

    monkeypatch.setattr(token_files, "CHUNK_BYTES", 500)
    rows = list(enumerate(odd_texts(4, 400)))
    path = f"file://{tmp_path}/files"
    write_token_files(spark.createDataFrame(rows, SCHEMA), FILE, path, shards=6)
    assert spark.read.parquet(path).select("shard").distinct().count() > 3
    assert sorted(map(tuple, read_token_files(spark, path).collect()), key=lambda r: r[1]) == expected_rows(library, rows)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_counts(empty, FILE).collect() == [] and token_file_rows(empty, FILE).collect() == []
    clash = spark.createDataFrame([(1, "a", 2, 3, "x")], "doc_id long, text string, shard int, n_tokens long, symbols string")
    assert token_counts(clash, FILE).first().n_tokens == 1 and token_file_rows(clash, FILE).first().n_tokens == 2
