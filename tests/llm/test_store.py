import importlib
from pathlib import Path

import pytest

from rxsieve.llm import store
from rxsieve.llm.store import release, stored, stored_paths


def test_stored_frames_live_in_the_shared_folder_until_released(spark):
    folder = Path(store.shared_folder(spark).removeprefix("file:"))
    assert str(folder) == spark.conf.get("spark.checkpoint.dir")
    one, two = (store.stored(spark.range(5).selectExpr("id", "'x' as `with blank`"), n) for n in ("one", "two"))
    assert one.columns == ["id", "with blank"] and one.count() == 5
    assert len(list(folder.glob("one-*"))) == 1
    store.drop_stored(one)
    assert not list(folder.glob("one-*")) and two.count() == 5
    store.release(spark)
    assert not list(folder.glob("two-*"))


def test_release_keeps_what_it_is_told(spark):
    old = stored_paths()
    one, two = stored(spark.range(3), "one"), stored(spark.range(4), "two")
    release(spark, [*old, stored_paths()[-1]])
    assert two.count() == 4 and len(stored_paths()) == len(old) + 1
    with pytest.raises(Exception, match="does not exist|FILE_NOT_EXIST|PATH_NOT_FOUND"):
        one.count()


def test_pipeline_leaves_no_tables_of_finished_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    old = stored_paths()
    rows = pipeline.run(spark, "/root/testdata/sf0.001").count()
    left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in stored_paths() if p not in old]
    assert rows > 0 and set(left) == {"mixing", "shard-starts"} and left.count("mixing") == 1
