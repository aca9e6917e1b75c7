import random

import pytest
from pyspark.sql import functions as F

from ticklake.llm import common


def test_running_start(spark):
    rng = random.Random(0)
    rows = [(p, v, rng.randrange(9)) for p in (3, 0, 7) for v in range(4)]
    rng.shuffle(rows)
    got = {(r.part, r.volume): r.begin for r in
           common.running_start(spark.createDataFrame(rows, "part int, volume int, ids bigint"), "part", "volume", "ids", "begin").collect()}
    total = 0
    for p, v, n in sorted(rows):
        assert got[p, v] == total
        total += n


def test_written_table_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a bigint, b string")
    back = common.written(df, "test")
    assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert common.written(df.limit(0), "test").count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn"}.get(key, default))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())


def test_released_deletes_what_was_written_inside(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    before = common.written(df, "stays")
    with pytest.raises(RuntimeError), common.released(spark):
        inside = common.written(df, "goes")
        kept = common.written(inside, "named", common.shared_folder(spark) + "/named-by-caller")
        raise RuntimeError
    assert before.count() == kept.count() == 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        inside.count()


@pytest.mark.parametrize("most_bits", [1 << 27, 1 << 15, 8])
def test_sifted_rows_are_all_there(spark, most_bits):
    df = spark.range(20_000).selectExpr("if(id % 7 = 0, null, id) as k", "cast(id as string) as _page", "id")
    marked = spark.range(0, 20_000, 40).selectExpr("id + 1 as m")
    clear, rest = common.sifted(df, F.xxhash64("k"), marked, F.xxhash64("m"), most_bits)
    assert clear.columns == rest.columns == df.columns
    out, kept = ({r.id for r in x.collect()} for x in (clear, rest))
    assert not out & kept and out | kept == set(range(20_000))
    assert {i for i in range(1, 20_000, 40) if i % 7} <= kept
    assert most_bits == 8 or len(kept) < 5_000
    nothing, none = common.sifted(df, F.xxhash64("k"), marked.limit(0), F.xxhash64("m"), most_bits)
    assert nothing.count() == 20_000 and none.count() == 0
