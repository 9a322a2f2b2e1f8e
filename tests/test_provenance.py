"""Settled rule rows against the plan that the loader takes, for every feed, field and shape."""

from fieldledger.operators import provenance, rules
from fieldledger.operators.rules import Field, Overrides, Profile

SHAPES = {
    "plain": ("text", None), "number": ("integer", None), "flag": ("boolean", None), "ref": ("object", ["id", "name"]),
    "object": ("object", ["street"]), "objects": ("array", ["id"]), "list": ("array", None), "none": ("unknown", None),
}


def plain(row) -> Field | None:
    spread = dict(part.split("=") for part in row["spread"].split(",")) if row["spread"] else {}
    return Field(row["field"], row["column"], row["type"], row["key"], spread, row["skip"] == "true")


def same(settled: Field, plan: Field) -> bool:
    if plan.skip or plan.spread:
        return (settled.skip, dict(settled.spread)) == (plan.skip, dict(plan.spread) if not plan.skip else {})
    return (settled.target, settled.type, settled.key, settled.skip) == (plan.target, plan.type, plan.key, False)


def test_rows_settle_what_the_plan_settles(spark):
    general = {*rules.COMMON_NAMES, *rules.TIMESTAMP_FIELDS, *rules.CORRECTED_TYPES, *rules.SKIPPED_EVERYWHERE, *rules.FLAG_NAMES, "address", "ownerId", "anyField", "uri", "id"}
    for shape, (kind, keys) in SHAPES.items():
        rows = [(feed, name, kind, keys) for feed, known in rules.FEEDS.items() for name in sorted(known.known() | general)]
        got = provenance.settled_rules(spark.createDataFrame(rows, "feed string, field string, api_type string, keys array<string>")).collect()
        found = {(r["feed"], r["field"]): plain(r) for r in got}
        assert len(found) == len(got)
        for feed, name, _, _ in rows:
            plan = None if rules.FEEDS[feed].skip_feed else rules.field_plan(name, Profile(kind, tuple(keys or ())), feed)
            made = found.pop((feed, name), None)
            assert (made is None) == (plan is None) and (plan is None or same(made, plan)), (shape, feed, name, made, plan)
        assert not found


def test_declared_fields_and_sources(spark):
    feeds = {"a": Overrides(ids="boss", times="due", skip="junk", literal="box"), "b": Overrides(skip_feed=True, reals="x"), "c": Overrides(reals="y")}
    rows = [("a", "created", "integer", None), ("a", "box", "object", ["id"]), ("a", "boss", "array", ["id"]), ("b", "x", "text", None)]
    catalogue = spark.createDataFrame(rows, "feed string, field string, api_type string, keys array<string>")
    got = {r["field"]: r for r in provenance.settled_rules(catalogue, feeds).collect()}
    assert set(got) == {"created", "box", "boss", "due", "junk"}  # feed b is skipped, feed c was not seen
    assert (got["created"]["column"], got["created"]["column_by"], got["created"]["type_by"]) == ("created_at", "rename", "rename")
    assert (got["box"]["key"], got["box"]["type"], got["box"]["type_by"]) == (None, "text", "text")
    assert (got["boss"]["skip"], got["boss"]["key_by"], got["boss"]["column"]) == (None, "override", "boss_id")
    assert (got["due"]["observed"], got["due"]["type_by"], got["due"]["column_by"]) == (False, "override", "name")
    assert got["junk"]["skip_by"] == "override" and got["junk"]["column"] is None
    assert provenance.settled_rules(catalogue.limit(0), feeds).count() == 0
