import time

from daybook.llm.tables import _CLEANUP, written


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {b for b in blocks.split(",") if b.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, conf = shuffle_files(spark), spark.conf.get(_CLEANUP, None)
    d = spark.range(1000).repartition(3, "id").groupBy("id").count()
    out = written(d, "grouped")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 1000 and spark.conf.get(_CLEANUP, None) == conf
    d.collect()  # what is not written keeps its files, so the check above can fail
    assert shuffle_files(spark) - before
