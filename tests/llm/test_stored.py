"""What ``saved`` leaves behind."""

import time

from lakeload.llm.common import SHUFFLE_CLEANUP, saved


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_as_a_stored_step_ends(spark, make):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    counts = make([(i, f"w{i % 7}") for i in range(100)]).repartition(5, "text").groupBy("text").count()
    stored = saved(counts, "counts")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and stored.row_count == 7
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, counts.collect()))
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
