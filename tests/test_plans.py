"""Publishing of built folders, what queries leave behind, file pruning."""
import os

import pytest
from conftest import SF001

from taxiframe.queries import REGISTRY
from taxiframe.session import shared_dir
from taxiframe.sources.derived import publish


def test_publish_keeps_the_first_copy(spark, tmp):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp}/first")
    spark.createDataFrame([(2,), (3,)], "a int").write.parquet(f"{tmp}/second")
    publish(spark, f"{tmp}/first", f"{tmp}/final")
    publish(spark, f"{tmp}/second", f"{tmp}/final")  # lost the race: dropped
    assert not os.path.exists(f"{tmp}/second")
    assert [r[0] for r in spark.read.parquet(f"{tmp}/final").collect()] == [1]


def test_publish_replaces_a_broken_copy(spark, tmp):
    """A final folder without its marker is what a broken run left."""
    os.makedirs(f"{tmp}/final")
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{tmp}/new")
    publish(spark, f"{tmp}/new", f"{tmp}/final")
    assert [r[0] for r in spark.read.parquet(f"{tmp}/final").collect()] == [2]


def test_publish_keeps_the_copy_that_it_cannot_move(spark, tmp):
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{tmp}/new")
    open(f"{tmp}/file", "w").close()
    with pytest.raises(Exception):  # noqa: B017 - what the file system says
        publish(spark, f"{tmp}/new", f"{tmp}/file/below")
    assert os.path.exists(f"{tmp}/new/_SUCCESS")


def test_queries_leave_no_further_copies(spark):
    for _ in range(2):
        for key in ("read_staged", "append_tmp", "read_raw", "coord_ranges"):
            REGISTRY[key](spark, SF001).count()
        folders = sorted(os.listdir(shared_dir(spark).removeprefix("file:")))
    REGISTRY["append_tmp"](spark, SF001).count()
    assert sorted(os.listdir(shared_dir(spark).removeprefix("file:"))) == folders
    assert not [f for f in folders if ".tmp-" in f]


def test_month_globs_open_only_their_files(spark):
    df = REGISTRY["select_months"](spark, SF001)
    months = {f.split("tripdata_")[1][:7] for f in df.inputFiles()}
    assert months == {"1996-03", "1998-11"}


def test_shared_folder_is_required_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
