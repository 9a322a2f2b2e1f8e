import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldledger import schema
from fieldledger.operators import merge
from fieldledger.sources.store import TableStore
from fieldledger.streaming.load import Loader, incremental, stream_upserts

C = F.col
ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("updated_at", T.LongType())])
LAYOUTS = {"thing": (ROW, "id")}


def store_at(spark, folder, **extra):
    return TableStore(spark, str(folder), 4, {**LAYOUTS, **extra})


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def things(spark, *values):
    return spark.createDataFrame([(i, a, None, None) for i, a in values], ROW)


def test_a_row_is_replaced_as_a_whole(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.upsert("thing", spark.createDataFrame([(1, "a", "b")], "id long, a string, b string"))
    store.upsert("thing", spark.createDataFrame([(1, "z")], "id long, a string"))
    assert rows(store.read("thing")) == [(1, "z", None, None)]


def test_counts_and_replays(spark, tmp_path):
    store = store_at(spark, tmp_path)
    assert store.count("thing") == -1 and rows(store.read("thing")) == []
    assert store.upsert("thing", things(spark, *[(i, "old") for i in range(50)])) == 50
    changes = things(spark, (3, "new"), (99, "new"))
    assert [store.upsert("thing", changes) for _ in range(2)] == [1, 0], "the second time nothing is new"
    got = {r[0]: r[1] for r in rows(store.read("thing"))}
    assert len(got) == 51 and got[3] == got[99] == "new" and got[4] == "old"
    assert store.upsert("thing", things(spark)) == 0 and store.count("thing") == 51


def files_of(folder):
    return {p.parent.name: p.name for p in sorted(folder.glob("thing/bucket=*/*.parquet"))}


def test_only_touched_partitions_are_written(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.upsert("thing", things(spark, *[(i, "old") for i in range(50)]))
    first = files_of(tmp_path)
    store.upsert("thing", things(spark, (3, "new")))
    second = files_of(tmp_path)
    assert sum(first[b] != second[b] for b in first) == 1
    assert not list((tmp_path / "_staging").iterdir()), "what was written aside is gone"


def test_key_ranges_keep_changes_local(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), 4, LAYOUTS, bucket_rows=10)
    store.upsert("thing", things(spark, *[(i, "old") for i in range(-5, 95)]))
    first = files_of(tmp_path)
    store.upsert("thing", things(spark, (93, "new"), (96, "new"), (101, "new")))
    second = files_of(tmp_path)
    assert sorted(int(b[7:]) for b in first) == list(range(-1, 10))
    assert sorted(b for b in second if second[b] != first.get(b)) == ["bucket=10", "bucket=9"]
    got = {r[0]: r[1] for r in rows(store.read("thing"))}
    assert len(got) == 102 and got[93] == "new" and got[-5] == "old"


def test_clear_and_replace(spark, tmp_path):
    store = store_at(spark, tmp_path)
    store.upsert("thing", things(spark, (1, "a"), (2, "b")))
    store.replace("thing", store.read("thing").where("id = 2").unionByName(things(spark, (7, "c"))))
    assert [r[0] for r in rows(store.read("thing"))] == [2, 7], "rows may come from the table itself"
    store.clear("thing")
    assert store.count("thing") == 0


@settings(max_examples=4, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.text("abc", max_size=2)), min_size=1, max_size=40),
    st.lists(st.integers(1, 39), max_size=3),
)
def test_splitting_a_batch_does_not_change_the_result(spark, changes, cuts):
    want = {k: v for k, v in changes if k is not None}
    edges = [0, *sorted(c for c in set(cuts) if c < len(changes)), len(changes)]
    stored = spark.createDataFrame([], "id long, v string")
    for a, b in zip(edges, edges[1:]):
        batch = spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(changes[a:b])], "id long, v string, pos long")
        latest = merge.last_arrivals(batch, "id", [C("pos")])
        stored = merge.upsert(stored, latest, "id")
        stored = merge.upsert(stored, latest, "id")  # applying a batch twice is the same
    assert dict(tuple(r) for r in stored.collect()) == want


def test_older_changes_are_dropped_on_request(spark):
    layout = "id long, v string, updated_at long"
    stored = spark.createDataFrame([(1, "s", 10), (2, "s", 10), (3, "s", None), (4, "s", 10)], layout)
    changes = spark.createDataFrame([(1, "old", 9), (2, "same", 10), (3, "c", 1), (4, "c", None), (5, "new", 1)], layout)
    got = {r.id: r.v for r in merge.upsert(stored, changes, "id", newer_by="updated_at").collect()}
    assert got == {1: "s", 2: "same", 3: "c", 4: "s", 5: "new"}


def test_deleted_rows(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    b = spark.createDataFrame([(1,), (None,), (5,)], "id long")
    assert {r[0] for r in merge.deleted(a, b, "id").collect()} == {2, None}


def test_incremental_keeps_the_filter_plain(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id long, updated_at long")
    assert [r.id for r in incremental(df, 5).collect()] == [2]
    assert incremental(df, None).count() == 3


def landed(spark, *bodies):
    return spark.createDataFrame([("", json.dumps(b)) for b in bodies], "pull string, body string")


def invoice(number, *items, **more):
    full = [{"id": i, "description": "d", "quantity": 1, "price": 2, "subtotal": "1,000.50", "serviceLine": {"id": 3}} for i in items]
    return {"id": number, "customer": {"id": 4, "uri": "u"}, "paid": False, "items": full, **more}


def test_feed_with_children_marks_and_log(spark, tmp_path):
    ticks = iter(range(1000, 2000, 10))
    loader = Loader(TableStore(spark, str(tmp_path), 4), clock=lambda: next(ticks))
    body = {"data": {"invoices": [invoice(1, 10, 11), invoice(2), invoice(None, 12), invoice(1, 10, status="late")], "page": 1}}
    runs = loader.load("invoice", landed(spark, body))
    assert [(r.table, r.fetched, r.upserted, r.status) for r in runs] == [("invoice", 4, 3, "success"), ("invoice_item", 3, 3, "success")]
    stored = {r.id: r for r in loader.store.read("invoice").collect()}
    assert set(stored) == {1, 2} and stored[1].status == "late" and stored[1].customer_id == 4 and stored[1].is_paid == 0
    items = {r.id: (r.invoice_id, r.subtotal, r.service_line_id) for r in loader.store.read("invoice_item").collect()}
    assert items == {10: (1, 1000.5, 3), 11: (1, 1000.5, 3)}
    rejected = loader.rejects().collect()
    assert [(r.resource, r.reason, json.loads(r.raw)["items"][0]["id"]) for r in rejected] == [("invoice", "no id", 12)]
    marks = {r.resource: (r.last_synced_at, r.record_count) for r in loader.store.read("sync_status").collect()}
    assert marks["invoice"] == (1000, 2)
    assert loader.since("invoice") == 1000 and loader.since("job") is None and loader.since("asset") == 946684800
    log = loader.store.read("sync_log")
    assert sorted((r.resource, r.status, r.records_fetched, r.records_upserted) for r in log.collect()) == [("invoice", "success", 4, 3), ("invoice_item", "success", 3, 3)]
    loader.reset("invoice")
    assert loader.store.count("invoice") == loader.store.count("invoice_item") == 0 and loader.since("invoice") is None
    assert dict(rows(loader.row_counts(["invoice", "region"]))) == {"invoice": 0, "region": -1}


def test_static_feeds_load_once_and_failures_stay_apart(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path), 4))
    tags = landed(spark, {"data": {"tags": [{"id": 1, "name": "t"}]}})
    broken = spark.createDataFrame([("x",)], "wrong string")
    runs = loader.load_all({"job": broken, "tag": tags, "company": landed(spark, {"data": {"companies": []}})})
    assert [(r.table, r.status) for r in runs] == [("tag", "success"), ("company", "success"), ("job", "failed")]
    assert loader.load("tag", tags)[0].status == "skipped"
    assert loader.load("tag", tags, full=True)[0].status == "success"
    assert loader.since("job") is None, "a failed load moves no mark"
    assert loader.load("region", tags)[0].status == loader.load("servicerequestitem", tags)[0].status == "skipped"


def test_recurrences_get_their_due_date(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path), 4))
    data = {"serviceRecurrences": [{"id": 1, "interval": 3, "currentServiceRecurrence": 1}, {"id": 2}], "serviceRequests": [{"id": -1, "windowStart": 77}]}
    assert loader.load("servicerecurrence", landed(spark, {"data": data}))[0].error is None
    got = {r.id: (r.currently_due, r.interval, r.current_service_recurrence_id) for r in loader.store.read("service_recurrence").collect()}
    assert got == {1: (77, 3, 1), 2: (None, None, None)}


def test_stream_of_pages_picks_up_new_files_only(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path / "store"), 4))
    folder = tmp_path / "landing" / "pull=1"
    folder.mkdir(parents=True)
    put = lambda name, *recs: (folder / name).write_text(json.dumps({"data": {"companies": list(recs), "page": 1}}))
    put("a.json", {"id": 1, "name": "one"}, {"id": 2, "name": "two"})
    loader.stream("company", str(tmp_path / "landing"), str(tmp_path / "check"))
    put("b.json", {"id": 2, "name": "deux"})
    loader.stream("company", str(tmp_path / "landing"), str(tmp_path / "check"))
    loader.stream("company", str(tmp_path / "landing"), str(tmp_path / "check"))
    assert {r.id: r.name for r in loader.store.read("company").collect()} == {1: "one", 2: "deux"}
    assert sorted(r.records_fetched for r in loader.store.read("sync_log").collect()) == [1, 2]


def company(number, name, **more):
    return {"id": number, "name": name, **more}


def page(folder, name, number, total, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"data": {"companies": list(records), "page": number, "totalPages": total}}))


def test_a_pull_waits_for_its_last_page(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path / "store"), 2), clock=lambda: 500)
    landing = tmp_path / "landing"
    go = lambda: loader.stream("company", str(landing), str(tmp_path / "check"), files_per_batch=2)
    names = lambda: {r.id: r.name for r in loader.store.read("company").collect()}
    page(landing / "pull=1", "a.json", 1, 3, company(1, "one"))
    page(landing / "pull=1", "b.json", 2, 3, company(2, "two"))
    go()
    assert loader.store.count("company") == -1 and loader.since("company") is None
    page(landing / "pull=2", "a.json", 1, 1, company(9, "nine"))
    go()
    assert names() == {9: "nine"} and loader.since("company") is None, "a whole pull does not wait for another one"
    page(landing / "pull=1", "c.json", 3, 3, company(3, "three"))
    go()
    assert names() == {1: "one", 2: "two", 3: "three", 9: "nine"} and loader.since("company") == 500
    page(landing / "pull=1", "d.json", 2, 3, company(2, "deux"))
    go()
    assert names()[2] == "deux", "a page that is delivered again loads at once"


def test_a_stream_goes_on_after_a_bad_page(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path / "store"), 2), clock=lambda: 500)
    landing = tmp_path / "landing"
    go = lambda: loader.stream("company", str(landing), str(tmp_path / "check"))
    page(landing / "pull=1", "a.json", 1, 2, company(1, "one"))
    (landing / "pull=1" / "b.json").write_text('{"data": {"companies": [{"id": 2, "na')
    go()
    assert [r.id for r in loader.store.read("company").collect()] == [1]
    assert [(r.reason, r.raw[:9]) for r in loader.rejects().collect()] == [("page cannot be read", '{"data": ')]
    assert loader.since("company") is None and {r.status for r in loader.store.read("sync_log").collect()} == {"partial"}
    page(landing / "pull=1", "c.json", 2, 2, company(2, "two"))
    go()
    assert sorted(r.id for r in loader.store.read("company").collect()) == [1, 2] and loader.since("company") == 500


def test_values_that_do_not_fit_are_kept_aside(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path), 2))
    good = {"created": 5, "updated": 6, "customer": True}
    body = {"data": {"companies": [company(1, "one", **good), company(2, "two", created="yesterday", updated=7), company(None, "none", created="never")]}}
    runs = loader.load("company", landed(spark, body))
    assert [(r.fetched, r.upserted, r.status) for r in runs] == [(3, 2, "success")]
    found = {(r.id, r.field, r.raw, r.reason) for r in loader.rejects().collect() if r.field}
    assert found == {(2, "created", "yesterday", "not timestamp"), (None, "created", "never", "not timestamp")}
    assert {r.id: (r.created_at, r.updated_at) for r in loader.store.read("company").collect()} == {1: (5, 6), 2: (None, 7)}
    assert sum(r.reason == "no id" for r in loader.rejects().collect()) == 1


def test_children_are_chosen_one_by_one(spark, tmp_path):
    loader = Loader(TableStore(spark, str(tmp_path), 2))
    body = {"data": {"invoices": [invoice(1, 10, 11), invoice(2, 20), invoice(3)]}}
    details = spark.createDataFrame([(1, '{"id": 11, "description": "detail", "quantity": 9}'), (3, '{"id": 30, "description": "alone"}')], "invoice_id long, text string")
    runs = loader.load("invoice", landed(spark, body), details=details.select("invoice_id", F.parse_json("text").alias("record")))
    assert [(r.table, r.fetched, r.status) for r in runs] == [("invoice", 3, "success"), ("invoice_item", 4, "success")]
    got = {r.id: (r.invoice_id, r.description) for r in loader.store.read("invoice_item").collect()}
    assert got == {10: (1, "d"), 11: (1, "detail"), 20: (2, "d"), 30: (3, "alone")}


def test_rules_do_not_depend_on_batches(spark, tmp_path):
    """The first value of a field that is not null decides, also over batches; later ones do not turn it."""
    halves = [[{"id": 1, "note": None, "brand": {"id": 4}}, {"id": 2, "note": 7}], [{"id": 3, "note": "x", "brand": 9}]]
    seen = []
    for cuts in (halves, [halves[0] + halves[1]]):
        loader = Loader(TableStore(spark, str(tmp_path / str(len(cuts))), 2))
        for number, records in enumerate(cuts):
            loader.load("company", spark.createDataFrame([(str(number), json.dumps({"data": {"companies": records}}))], "pull string, body string"))
        stored = loader.store.read("_profiles").select("field", "api_type", "keys").collect()
        first = {f: next(k for k in ("object", "integer", "text", "unknown") if (f, k) in {(r.field, r.api_type) for r in stored}) for f in ("id", "note", "brand")}
        seen.append((first, loader.plan("company", spark.createDataFrame([], "pull string, page long, pos int, record variant"))))
    assert seen[0] == seen[1] and seen[0][0] == {"id": "integer", "note": "integer", "brand": "object"}


def test_stream_of_rows(spark, tmp_path):
    store = store_at(spark, tmp_path / "store")
    layout = "id long, a string, b string, updated_at long, seq long"
    for seq in range(3):
        spark.createDataFrame([(i, f"v{seq}", None, seq, seq) for i in range(seq, 5)], layout).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream_upserts(store, "thing", str(tmp_path / "in"), layout, ["seq"], str(tmp_path / "check"), files_per_batch=2)
    assert [r[1] for r in rows(store.read("thing"))] == ["v0", "v1", "v2", "v2", "v2"]


def test_layouts():
    assert schema.resolve_table("service_line") == schema.resolve_table("serviceline") == "service_line"
    assert schema.resolve_table("nothing") is None
    assert len(schema.TABLE_COLUMNS) == 19
    widths = {t: len(schema.table_schema(t)) for t in schema.TABLE_COLUMNS}
    assert (widths["job"], widths["company"], widths["service_request"], widths["user"]) == (43, 17, 29, 21)
    assert schema.table_schema("job")["status"].metadata["comment"].startswith("new|")
