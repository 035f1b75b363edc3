from yieldline.session import new_folder, shared_folder, sized_for


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    assert shared_folder(spark) == shared_folder(spark)
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_folder(spark))


def test_reduce_tasks_grow_with_the_shuffle():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert sized_for(1)[key] == "200"
    assert sized_for(10 << 40)[key] == str(10 * 4096)
