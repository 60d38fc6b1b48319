"""What fits, folds and settings leave on disk and in memory."""

import os
import time
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from kestrel import session
from kestrel.operators import recommend as rec


def ratings(spark):
    return spark.createDataFrame([(u, i, 1 + (u + i) % 3, float(1 + (u + i) % 3)) for u in range(30) for i in range(20) if (u * i + u) % 5 < 3],
                                 "user int, item int, cnt int, rating double").repartition(3).cache()


def tables(spark):
    folder = urlparse(session.checkpoint_dir(spark)).path
    return {f for f in os.listdir(folder) if f.startswith("kestrel-")}


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return sum(f.startswith("shuffle_") for d in env.blockManager().diskBlockManager().localDirsString() for _, _, fs in os.walk(d) for f in fs)


def test_written_tables_leave_no_shuffle_files(spark):
    session.collect_garbage(spark)
    time.sleep(2)
    before, own = shuffle_files(spark), spark.conf.get(session.DROP_SHUFFLES)
    out = session.written(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "sums")
    assert out.count() == 7 and spark.conf.get(session.DROP_SHUFFLES) == own
    time.sleep(1)
    # the count's own few
    assert shuffle_files(spark) - before <= 4


def test_scratch_tables_of_a_block_go_with_it(spark):
    kept = session.written(spark.range(5), "outer")
    with session.scratch_discarded(spark):
        path = session.scratch_path(spark, "inner")
        spark.range(5).write.parquet(path)
        assert os.path.exists(urlparse(path).path)
        with session.scratch_discarded(spark):
            pass
    assert not os.path.exists(urlparse(path).path) and kept.count() == 5


@pytest.mark.parametrize("side_by_side", [0, 1_000_000])
def test_folds_and_settings_leave_no_tables(spark, monkeypatch, side_by_side):
    data = ratings(spark)
    monkeypatch.setattr(rec, "SIDE_BY_SIDE", side_by_side)
    monkeypatch.setattr(rec, "fit_als", lambda train, *a, fit=rec.fit_als, **k: fit(train, 2, 1, blocks=2))
    seen = tables(spark)
    folds = rec.cross_validated_auc(data, data.select("item").distinct(), 3)
    grid = rec.grid_search(data, data, data.select("item").distinct(), (2, 3), (0.1,), (1.0,))
    left = {f.rsplit("-", 1)[0] for f in tables(spark) - seen}
    assert not left & {"kestrel-als", "kestrel-levels"} and sum("kestrel-positives" in f for f in tables(spark) - seen) == 1
    assert folds.count() == 3 and grid.count() == 2


def test_blocks_grow_with_the_ratings(spark, monkeypatch):
    data, made = ratings(spark), []

    class Recorded(rec.ALS):
        def __init__(self, **kw):
            made.append(kw["numUserBlocks"])
            super().__init__(**kw)

    monkeypatch.setattr(rec, "ALS", Recorded)
    monkeypatch.setattr(rec, "BLOCK_RATINGS", 10)
    model = rec.fit_als(data, rank=2, max_iter=1)
    assert made[0] >= data.count() / 10
    assert rec.als_scorer(model)(data.select("user", "item")).count() == data.count()
