import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from fieldledger.operators.running import positions, running

C = F.col


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_totals(spark, group):
    draw = random.Random(1)
    data = [(draw.choice([1, 1, 1, 2, 3]), n, draw.randrange(100)) for n in range(300)]
    df = spark.createDataFrame(draw.sample(data, len(data)), "g long, n long, v long")
    made = running(df, group, [C("n").desc()], place=("count", F.lit(1)), total=("sum", C("v")), mark=("bit_xor", C("v")))
    got = {(r.g, r.n): (r.place, r.total, r.mark) for r in made.collect()}
    want = {}
    for key in {1, 2, 3} if group else {None}:
        own = sorted((d for d in data if key in (None, d[0])), key=lambda d: -d[1])
        for place, (row, total, mark) in enumerate(zip(own, accumulate(d[2] for d in own), accumulate((d[2] for d in own), lambda a, b: a ^ b)), 1):
            want[row[0], row[1]] = (place, total, mark)
    assert got == want


def test_positions_of_equal_rows_spread(spark):
    df = spark.range(500).select((C("id") % 2).alias("k"))
    made = positions(df, [C("k").asc()])
    assert sorted(r.position for r in made.collect()) == list(range(1, 501))
    assert made.where("k = 0").agg(F.max("position")).first()[0] == 250
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert positions(df.limit(0), [C("k").asc()]).collect() == []
