import pytest

from rowloom.session import checkpointed, fits_broadcast, shared_dir


def test_the_named_folder_is_used(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpointed(spark.range(5)).count() == 5


class Elsewhere:
    """Looks like a session on a cluster without a checkpoint folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_has_to_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Elsewhere)


def test_broadcast_bounds(spark):
    assert fits_broadcast(spark.range(0)) and fits_broadcast(spark.range(9), max_rows=9)
    assert not fits_broadcast(spark.range(10), max_rows=9)
    texts = spark.sql("select repeat('é', 100) s, array(1, 2) a, null n")
    assert fits_broadcast(texts, max_bytes=300) and not fits_broadcast(texts, max_bytes=200)
