from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from farelake.llm import common


def tables(spark, name):
    return sorted(Path(common.scratch(spark).removeprefix("file:")).glob(f"{name}-*"))


def test_tables_of_a_block_go_but_for_the_kept(spark):
    with common.steps(spark) as kept:
        common.stored(spark.range(3), "x1")
        with common.steps(spark) as inner:
            common.stored(spark.range(3), "x2")
            inner.append(common.stored(spark.range(4), "x3"))
        assert not tables(spark, "x2") and tables(spark, "x3")
        kept.append(last := common.stored(spark.range(5), "x4"))
    assert not tables(spark, "x1") and not tables(spark, "x3")
    assert last.count() == 5


def test_a_block_that_fails_leaves_nothing(spark):
    with pytest.raises(RuntimeError), common.steps(spark) as kept:
        kept.append(common.stored(spark.range(3), "y1"))
        raise RuntimeError
    assert not tables(spark, "y1")


def test_threads_keep_their_own_tables(spark):
    before = spark.conf.get(common._CLEANUP, "false")

    def work(k):
        with common.steps(spark) as kept:
            for _ in range(4):
                common.stored(spark.range(10 * k), f"z{k}")
            kept.append(last := common.stored(spark.range(k), f"z{k}"))
        return last.count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(work, range(1, 9))) == list(range(1, 9))
    assert all(len(tables(spark, f"z{k}")) == 1 for k in range(1, 9))
    assert spark.conf.get(common._CLEANUP, "false") == before
