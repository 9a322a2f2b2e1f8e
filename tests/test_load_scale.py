import json

from pyspark.sql import functions as F

from checks import feeds
from fieldledger.operators import merge, normalize, profile
from fieldledger.sources import pages
from fieldledger.sources.store import TableStore, setting
from fieldledger.streaming.load import Loader


def page_frame(spark, *records):
    return spark.createDataFrame([("", json.dumps({"data": {"jobs": list(records), "page": 1}}))], "pull string, body string")


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_do_not_carry_their_page(spark):
    landed = pages.landed(page_frame(spark, {"id": 1}, {"id": 2}), "job")
    above = optimized(landed).split("Generate")[0]
    assert "body" not in above and "data" not in above
    assert [(r.page, r.pos, r.bad) for r in landed.collect()] == [(1, 0, None), (1, 1, None)]


def test_children_do_not_carry_their_parent(spark):
    records = pages.records(page_frame(spark, {"id": 1, "items": [{"id": 5}, {"id": 6}]}, {"items": [{"id": 7}]}, {"id": 3}), "job")
    kids = normalize.children(records, "job_id")
    assert "variant_get" not in optimized(kids).split("Generate")[0]
    assert [(r.job_id, r.item, str(r.record)) for r in kids.orderBy("item").collect()] == [(1, 0, '{"id":5}'), (1, 1, '{"id":6}')]


def test_a_profile_looks_into_the_first_record_of_each_shape(spark):
    rows = [
        ("2", 1, 0, '{"id":1,"a":"x","b: BIGINT, c":1}'),
        ("10", 1, 0, '{"id":"t","a":null,"o":{"q":1}}'),
        ("2", 1, 1, '{"id":2,"a":"y","b: BIGINT, c":2}'),
        ("2", 1, 2, '{"id":3,"b":1,"c":2,"l":[{"k":1,"m":2}]}'),
        ("2", 1, 3, '{"id":4,"b":1,"c":2,"l":[{"z":1}]}'),
    ]
    records = spark.createDataFrame(rows, "pull string, page long, pos int, text string").select("pull", "page", "pos", F.parse_json("text").alias("record"))
    assert profile.first_of_shapes(records).count() == 4
    got = {(r.field, r.api_type): (r.pull, r.at & 7, r["keys"]) for r in profile.stored_profile(records, "job").collect()}
    assert got == {
        ("id", "integer"): ("2", 0, None),
        ("id", "text"): ("10", 0, None),
        ("a", "text"): ("2", 0, None),
        ("a", "unknown"): ("10", 0, None),
        ("b: BIGINT, c", "integer"): ("2", 0, None),
        ("o", "object"): ("10", 0, ["q"]),
        ("b", "integer"): ("2", 2, None),
        ("c", "integer"): ("2", 2, None),
        ("l", "array"): ("2", 2, ["k", "m"]),
    }


def test_only_rows_of_repeated_keys_are_sorted(spark):
    batch = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "c", 3), (1, "d", 2), (3, None, 1)], "id long, v string, pos long")
    twice = merge.repeated(batch, "id")
    assert [r.id for r in twice.collect()] == [1]
    order = [F.col("pos")]
    want = sorted(map(str, merge.last_arrivals(batch, "id", order).collect()))
    assert sorted(map(str, merge.last_of_repeated(batch, "id", order, twice).collect())) == want


def test_a_setting_of_the_session_stays(spark):
    name = "spark.sql.files.minPartitionNum"
    with setting(spark, name, 7):
        assert spark.conf.get(name) == "7"
        with setting(spark, name, 9):
            assert spark.conf.get(name) == "7"
    assert spark.conf.get(name, None) is None


def test_pages_land_side_by_side_and_wait_in_few_files(spark, tmp_path):
    bodies = [(pull, json.dumps({"data": {"companies": [{"id": n, "name": "x"}], "page": n, "totalPages": 21}})) for pull in ("1", "2") for n in range(1, 21)]
    feeds.land(spark.createDataFrame(bodies, "pull string, body string").repartition(3), str(tmp_path / "in"))
    files = sorted((tmp_path / "in").rglob("*.txt"))
    assert len(files) == 40 and {p.parent for p in files} == {tmp_path / "in" / "pull=1", tmp_path / "in" / "pull=2"}
    assert sorted(p.read_text().rstrip("\n") for p in files) == sorted(b for _, b in bodies)
    loader = Loader(TableStore(spark, str(tmp_path / "store"), 2), clock=lambda: 500)
    loader.stream("company", str(tmp_path / "in"), str(tmp_path / "check"))
    assert len(list((tmp_path / "store" / "_waiting").rglob("*.parquet"))) == 2, "one for each pull"
    assert {(r.pull, r.pages_landed, r.released) for r in loader.store.read("_pulls").collect()} == {("1", 20, None), ("2", 20, None)}
    assert [(r.status, r.error_message) for r in loader.store.read("sync_log").collect()] == [("partial", "2 pulls are not whole")]
    assert loader.store.count("company") == -1
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
