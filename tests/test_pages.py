import json

from pyspark.sql import functions as F

from fieldledger.operators import normalize, profile, rules
from fieldledger.operators.rules import Field, Profile
from fieldledger.sources import pages

C = F.col


def frame(spark, *bodies, pull=""):
    return spark.createDataFrame([(pull, b if isinstance(b, str) else json.dumps(b)) for b in bodies], "pull string, body string")


def ids(records):
    return [r[0] for r in records.orderBy("page", "pos").select(normalize.integer(C("record"), "id")).collect()]


def test_record_list_is_found_by_name_then_by_place(spark):
    one = [{"id": 1}]
    for body, feed in [
        (one, "company"),
        ({"data": one}, "company"),
        ({"data": {"x": [{"id": 9}], "companies": one}}, "company"),
        ({"data": {"x": [{"id": 9}], "jobs": one}}, "job"),
        ({"data": {"x": [{"id": 9}], "items": one}}, "job"),
        ({"jobs": one}, "job"),
        ({"data": {"page": 1, "pageSize": [7], "zeta": one, "alpha": [{"id": 9}]}}, "job"),
    ]:
        assert ids(pages.records(frame(spark, body), feed)) == [1], body


def test_pages_without_records(spark):
    for body in ({"data": {"items": []}}, {"data": {"page": 1}}, {"data": {"name": "x"}}, "no json", {"data": {"a": [], "b": [{"id": 1}]}}):
        assert ids(pages.records(frame(spark, body), "job")) == []


def test_side_sections_leave_out_the_records(spark):
    body = {"data": {"serviceRecurrences": [{"id": 1}], "serviceRequests": [{"id": 2}, {"id": 3}], "page": 1, "empty": []}}
    side = pages.side_sections(frame(spark, body), "servicerecurrence")
    assert [(r[0], r[1]) for r in side.groupBy("section").count().collect()] == [("serviceRequests", 2)]


def test_pages_from_files_keep_page_order(spark, tmp_path):
    for number in (2, 1, 3):
        folder = tmp_path / "pull=a"
        folder.mkdir(exist_ok=True)
        data = {"jobs": [{"id": number * 10 + k} for k in range(2)], "page": number, "totalPages": 3}
        (folder / f"{9 - number}.json").write_text(json.dumps({"data": data}, indent=1))
    landed = pages.read_pages(spark, str(tmp_path))
    assert ids(pages.records(landed, "job")) == [10, 11, 20, 21, 30, 31]
    summary = pages.paging_summary(landed).first()
    assert (summary.total_pages, summary.pages_landed, summary.complete) == (3, 3, True)
    assert pages.records(landed, "job").first().pull == "a"


def test_values_take_the_shape_they_come_in(spark):
    record = {
        "id": 5, "fk": {"id": 7, "name": "n"}, "bare": 8, "text": "9", "flag": True, "no": False, "money": "1,250.50",
        "bad": "n/a", "obj": {"a": [1]}, "list": ["x", "é"], "word": "true", "none": None, "address": "nowhere",
    }
    plan = [
        Field("fk", "fk_id", key="id"), Field("bare", "bare_id", key="id"), Field("none", "none_id", key="id"),
        Field("text", "text_n", "integer"), Field("flag"), Field("no"), Field("flag", "flag_n", "integer"),
        Field("money", type="real"), Field("bad", type="real"), Field("obj"), Field("list"), Field("word"), Field("none"),
        Field("address", spread=rules.ADDRESS_COLUMNS), Field("bare", "at", "timestamp"), Field("obj", "gone", skip=True),
    ]
    row = normalize.normalize(pages.records(frame(spark, [record]), "job"), plan, companions=True).first().asDict()
    assert row == {
        "id": 5, "fk_id": 7, "bare_id": 8, "none_id": None, "text_n": 9, "flag": "1", "no": "0", "flag_n": 1, "money": 1250.5,
        "bad": None, "obj": '{"a":[1]}', "list": '["x","é"]', "word": "true", "none": None, "address_street": None,
        "address_city": None, "address_state": None, "address_postal": None, "at": 8, "at_dt": "1970-01-01 00:00:08",
    }


def test_children_keep_their_parent(spark):
    parents = [{"id": 1, "items": [{"id": 10}, {"id": 11}]}, {"id": 2, "items": []}, {"id": 3}, {"items": [{"id": 12}]}]
    found = normalize.children(pages.records(frame(spark, parents), "invoice"), "invoice_id")
    got = found.select("invoice_id", normalize.integer(C("record"), "id")).collect()
    assert sorted(map(tuple, got)) == [(1, 10), (1, 11)]


def test_children_come_from_their_own_feed_one_by_one(spark):
    detail = pages.records(frame(spark, [{"id": 10, "price": 1}]), "item").select(F.lit(1).cast("long").alias("quote_id"), "record")
    for width in (3, 5):
        items = [{**{f"k{n}": n for n in range(width - 1)}, "id": 10}, {"id": 11, "price": 3}, {"price": 4}]
        parents = pages.records(frame(spark, [{"id": 0}, {"id": 1, "items": items}, {"id": 2, "items": [{"id": 10, "price": 5}]}]), "quote")
        got = normalize.choose_children(parents, "quote_id", detail).select("quote_id", normalize.integer(C("record"), "price")).collect()
        assert sorted(map(tuple, got)) == [(1, 1), (1, 3), (1, 4), (2, 5)]


def test_pages_are_read_record_by_record(spark):
    twice = '{"data":{"page":2,"totalPages":3,"jobs":[{"id":1,"a":1,"a":{"b":2,"b":3}},{"id":2}],"page":2}}'
    found = pages.landed(spark.createDataFrame([("", twice), ("", '[{"id":3},{"id":3'), ("", "  ")], "pull string, body string"), "job").collect()
    assert sorted((r.page, r.total_pages, r.bad is not None, r.pos) for r in found if r.pos is not None) == [(2, 3, False, 0), (2, 3, False, 1)]
    assert [r.bad for r in found if r.bad] == ['[{"id":3},{"id":3']
    assert json.loads(next(r.record.toJson() for r in found if r.pos == 0)) == {"id": 1, "a": {"b": 3}}


def test_record_texts(spark):
    bodies = ['{"data":{"page":4,"jobs":[{"id":1}],"side":[{"id":9}]}}', '[{"id":1}]', '{"data":[{"id":1}]}', '{"page":4,"odd":[{"id":1}],"side":[{"id":9}]}']
    found = spark.createDataFrame([(b,) for b in bodies], "body string").select(pages.record_texts(C("body"), "job")).collect()
    assert [r[0] for r in found] == [['{"id":1}']] * 4


def test_a_stored_profile_can_be_merged_in_any_way(spark):
    body = [{"id": n, **({"a": None} if n < 2 else {"a": "x" if n % 3 else n}), "o": [{"k": 1}] if n % 2 else {"z": 1}} for n in range(12)]
    records = pages.records(spark.createDataFrame([(str(n % 3), json.dumps({"data": {"jobs": [r], "page": n}})) for n, r in enumerate(body)], "pull string, body string"), "job").cache()
    whole = sorted(map(str, profile.merged_profile(profile.stored_profile(records, "job")).collect()))
    parts = [profile.stored_profile(records.where(C("page") % 4 == k), "job") for k in (3, 1, 0, 2)]
    left = profile.merged_profile(parts[0].unionByName(parts[1]))
    right = profile.merged_profile(parts[2].unionByName(parts[3]))
    assert sorted(map(str, profile.merged_profile(left.unionByName(right)).collect())) == whole


def test_due_date_of_the_last_side_record_wins(spark):
    data = {
        "serviceRecurrences": [{"id": n} for n in (1, 2, 3, 4)],
        "serviceRequests": [
            {"id": 100, "serviceRecurrence": 1, "windowStart": 10},
            {"id": -2, "windowStart": 20},
            {"id": -3, "serviceRecurrence": 1, "windowStart": 30},
            {"id": 101, "serviceRecurrence": 2, "windowStart": None},
        ],
    }
    landed = frame(spark, {"data": data})
    got = normalize.enrich_due(pages.records(landed, "servicerecurrence"), pages.section(landed, "serviceRequests"))
    rows = {r[0]: (r.currently_due, r.matched) for r in got.select(normalize.integer(C("record"), "id"), "currently_due", "matched").collect()}
    assert rows == {1: (30, True), 2: (None, True), 3: (30, True), 4: (None, False)}
    assert tuple(normalize.match_ratio(got).first()) == (3, 4)


def test_profile_takes_the_first_known_value(spark):
    first = [{"id": 1, "a": None, "b": 1, "c": 1.0, "d": True, "e": [], "f": [{"k": 1}], "g": {"y": 1, "x": 2}, "h": 12345678901234567890123}]
    second = [{"id": 2, "a": "x", "b": "late", "e": [{"z": 1}], "n": None}]
    landed = frame(spark, {"data": {"jobs": first, "page": 1}}, {"data": {"jobs": second, "page": 2}})
    records = pages.records(landed, "job")
    want = {
        "id": "integer", "a": "text", "b": "integer", "c": "real", "d": "boolean", "e": "array", "f": "array",
        "g": "object", "h": "integer", "n": "unknown",
    }
    assert {r.field: r.api_type for r in profile.field_profile(records).collect()} == want
    nested = {r.field: (r.api_type, r["keys"] and sorted(r["keys"])) for r in profile.nested_keys(records).collect()}
    assert {f: t for f, (t, _) in nested.items()} == want
    assert {f: k for f, (_, k) in nested.items() if k} == {"f": ["k"], "g": ["x", "y"]}


def test_child_feed_mode(spark):
    parents = pages.records(frame(spark, [{"id": 1, "items": [{"id": 1, "uri": "u"}]}]), "quote")
    for record, mode in (({"id": 1, "uri": "u", "price": 2}, "parent_endpoint"), ({"id": 1, "uri": "u"}, "inline"), ({"id": 1, "price": 1, "z": 1}, "inline")):
        detail = pages.records(frame(spark, [record]), "item")
        assert [r[0] for r in profile.child_feed_mode(parents, detail).collect()] == [mode]


def test_rule_precedence():
    plan = lambda n, p, f="job": rules.field_plan(n, p, f)
    assert plan("id", Profile("integer")) is None and plan("uri", Profile("text")) is None
    assert plan("tags", Profile("array", ("id",))).skip
    assert plan("created", Profile("integer")) == Field("created", "created_at", "timestamp")
    assert plan("scheduledDate", Profile("integer")).type == "timestamp"
    assert plan("estimatedPrice", Profile("integer")).type == "real"
    assert plan("vendor", Profile("object", ("id", "name"))) == Field("vendor", "vendor_id", "integer", "id")
    assert plan("serviceLine", Profile("text")) == Field("serviceLine", "service_line")
    assert plan("serviceLine", Profile("object", ("id",))).key is None
    assert plan("parts", Profile("array", ("id",))).skip
    assert plan("labels", Profile("array")).type == "text"
    assert plan("isProject", Profile("boolean")) == Field("isProject", None, "integer")
    assert plan("customer", Profile("boolean"), "company").target == "is_customer"
    assert plan("customer", Profile("object", ("id",)), "invoice").target == "customer_id"
    assert plan("address", Profile("object", ("street",)), "company").spread == rules.ADDRESS_COLUMNS
    assert plan("sales", Profile(), "job") == Field("sales", "sales_id", "integer", "id")
    assert plan("windowStart", Profile("integer"), "invoiceitem").skip
    extra = rules.resource_plan({"id": Profile("integer")}, "servicerecurrence")
    assert Field("currently_due", None, "timestamp") in extra


def test_plans_fill_the_stored_columns():
    """Every column a rule names exists in its table."""
    from fieldledger import schema

    for feed in rules.planned_feeds():
        table = schema.table_name(feed)
        if table in schema.TABLE_COLUMNS:
            named = {f.target for f in rules.resource_plan({}, feed) if not f.skip}
            assert named <= set(schema.TABLE_COLUMNS[table].split()), feed


def test_warnings(spark):
    rows = [("job", "sales", "unknown", None), ("job", "other", "unknown", None), ("job", "jobTypeWeight", "unknown", None), ("job", "dueBy", "unknown", None), ("nofeed", "x", "text", None), ("servicerequestitem", "x", "unknown", None), ("job", "id", "unknown", None)]
    catalogue = spark.createDataFrame(rows, "feed string, field string, api_type string, keys array<string>")
    got = {(r.feed, r.field) for r in profile.rule_warnings(catalogue).collect()}
    assert got == {("job", "other"), ("job", "jobTypeWeight"), ("nofeed", None)}
