from __future__ import annotations

import os

from eventide.llm import common


def test_saved_dropped_and_cleared(spark):
    a, b = (common.saved(spark.range(3), name) for name in ("a", "b"))
    folders = [f.removeprefix("file:") for f in common._made[-2:]]
    assert a.count() == b.count() == 3 and all(map(os.path.isdir, folders))
    common.dropped(a)
    assert [os.path.isdir(f) for f in folders] == [False, True]
    common.clear_scratch(spark)
    assert not os.path.isdir(folders[1]) and not common._made
    empty = common.saved(spark.range(0), "e")
    assert empty.count() == 0
    common.dropped(empty)
    common.clear_scratch(spark)


def test_discard_keeps_the_last_table(spark):
    first = common.made()
    common.discard(spark, first)
    kept = [common.saved(spark.range(n), "t") for n in (3, 2, 0)][-1]
    folders = [f.removeprefix("file:") for f in common._made[first:]]
    common.discard(spark, first)
    assert [os.path.isdir(f) for f in folders] == [False, False, True] and common.made() == first + 1 and kept.count() == 0
    common.clear_scratch(spark)


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a_ int")
    assert common.free_name(df, "a", "a", "b") == ["a__", "a___", "b"]
