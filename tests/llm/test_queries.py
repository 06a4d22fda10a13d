"""Registered queries against their SQL, and the pipeline against plain Python, on the smallest tables."""

import importlib
import inspect
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from rxsieve.llm.mixing import mix
from rxsieve.llm.queries import ORACLES, QUERIES, TOKENIZER
from rxsieve.llm.toxicity import toxicity
from tests.llm import brute

DATA = Path("/root/testdata/sf0.001")
pipeline = importlib.import_module("corpus_pipeline")
entry = importlib.import_module("__spark_entry__")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")

COLUMNS = {
    "op1": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op2": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op4": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op7": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op9": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op13": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"},
}

#: Tables other than the documents whose rows a query returns one by one; None for rows of another kind.
TABLES = {"op3": "pages", "op11": None, "op12": "embeddings", "op13": None}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    yield con
    con.close()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    frame = QUERIES[name](spark, str(DATA))
    wanted = COLUMNS.get(name.split("_")[0], {})
    assert {c: t for c, t in frame.dtypes if c in wanted} == wanted
    table = TABLES.get(name.split("_")[0], "documents")
    if table:
        assert frame.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(DATA))
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(repr([r[n] for n in names]) for r in frame.collect()) == sorted(repr(list(r)) for r in result.fetchall())


def test_repeats_equal_all_windows(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect())
    got = {r.doc_id: tuple(r)[1:5] for r in QUERIES["op1_suffix_array_dedup"](spark, str(DATA)).collect()}
    assert got == dict(zip([d for d, _ in docs], brute.without_repeats([t for _, t in docs]), strict=True))


def test_pipeline_stage_by_stage(spark, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near copies", "decontamination", "mixing", "token files"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    table = lambda n: spark.read.parquet(f"{DATA}/{n}.parquet")
    stages = dict(pipeline.STAGES)
    run = lambda n, d: stages[n](spark, d, str(DATA))
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}

    calm = run("toxicity", docs)
    assert calm.columns == docs.columns
    assert ids(calm) == ids(toxicity(docs, table("labels")).where("predicted = 0")) and 0 < calm.count() < docs.count()

    single = run("near copies", calm)
    parts = brute.near_components({r.doc_id: r.text for r in calm.collect()})
    assert single.columns == docs.columns and ids(single) == {d for d, (n, c) in parts.items() if c == d or not n} != ids(calm)

    clean = run("decontamination", single)
    rows = single.collect()
    found = brute.passages([r.text for r in rows], [(r.item_id, r.text) for r in table("benchmark").collect()])
    assert clean.columns == docs.columns and ids(clean) == {r.doc_id for r, (_, hit, _) in zip(rows, found, strict=True) if not hit}

    mixed = run("mixing", clean)
    copies = {r.row.doc_id: r.copies for r in mix(clean).collect()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({d: c for d, c in copies.items() if c})

    mixed.write.parquet(str(tmp_path / "mixed"))
    library, at, expected = Tokenizer.from_file(TOKENIZER), 0, []
    for r in sorted(spark.read.parquet(str(tmp_path / "mixed")).collect()):
        tokens = [*library.encode(r.text, add_special_tokens=False).ids, 0]
        expected.append((r.doc_id, at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        at += len(tokens)
    whole = sorted(map(tuple, pipeline.run(spark, str(DATA)).collect()), key=lambda r: r[1])
    assert whole == expected


def test_operators_stay_inside_the_package():
    """Nothing else in the library imports the package."""
    root = Path(inspect.getfile(pipeline)).parent
    for file in (root / "rxsieve").rglob("*.py"):
        if "llm" not in file.parts:
            assert "rxsieve.llm" not in file.read_text(), file
