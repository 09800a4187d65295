"""Documents as rows: golden rows, strict types, partial values, nesting, text files."""

import json
from datetime import datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docrel.functions import codec
from docrel.operators import flatten as flat
from docrel.operators import load, nest
from docrel.plans.schema import FlattenPlan, parse_schema
from docrel.sources.readers import find_documents, read_documents, read_tsv, rows_by_ids, tables_by_ids
from tests.test_plans import INSERTS, OID, POSTS2


def parsed(spark, *docs):
    return flat.parse(spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "doc string"))


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def oid(x):
    return {"$oid": x}


def date(x):
    return {"$date": x}


DOC = {"_id": oid("56b8f05cf9fcee1b00000010"), "title": "title3（:", "body": 'body3"\tbody2\nbody1', "user_id": "56b8d7caf9fcee1b00000001",
       "updated_at": date("2016-02-08T19:45:32.501Z"), "created_at": date("2016-02-08T19:45:32.501Z"),
       "comments": [{"_id": oid("56b8f05cf9fcee1b00000110"), "updated_at": date("2016-02-08T19:45:32.501Z"), "created_at": date("2016-02-08T19:45:32.501Z"), "items": [{"data": "1"}], "slugs": [22]},
                    {"_id": oid("56b8f05cf9fcee1b00000011"), "body": "body2", "updated_at": date("2016-02-08T19:45:33.501Z"), "created_at": date("2016-02-08T19:45:33.501Z"), "items": [{"data": "2"}]}]}


def at(second):
    return datetime(2016, 2, 8, 19, 45, second, 501000, tzinfo=timezone.utc).timestamp()


def test_golden_rows(spark):
    tables = flat.flatten_all(parsed(spark, DOC), INSERTS)
    root = tables["a_inserts"].withColumns({c: F.unix_micros(c) / 1e6 for c in ("created_at", "updated_at")})
    assert rows(root) == [(DOC["body"], at(32), 7, "56b8f05cf9fcee1b00000010", DOC["title"], at(32), "56b8d7caf9fcee1b00000001")]
    comments = tables["a_insert_comments"].withColumns({c: F.unix_micros(c) / 1e6 for c in ("created_at", "updated_at")})
    assert rows(comments, ["idx"]) == [("56b8f05cf9fcee1b00000010", None, at(32), 7, "56b8f05cf9fcee1b00000110", at(32), 1),
                                       ("56b8f05cf9fcee1b00000010", "body2", at(33), 7, "56b8f05cf9fcee1b00000011", at(33), 2)]
    assert rows(tables["a_insert_comment_items"], ["a_inserts_comments_idx"]) == [("56b8f05cf9fcee1b00000010", "1", 1, 1), ("56b8f05cf9fcee1b00000010", "2", 2, 1)]
    assert rows(tables["a_insert_comment_slugs"]) == [("56b8f05cf9fcee1b00000010", 22, 1, 1)]
    assert [r.idx for r in flat.with_offsets(tables["a_insert_comments"], {"idx": 100}).orderBy("idx").collect()] == [101, 102]


def test_nested_positions(spark):
    doc = {"_id": 133, "comments": [{"struct": {"tests": [{"v": 1, "nested": [20]}, {"v": 2, "nested": [23, 24]}]}}, {"struct": {"tests": [{"v": 3, "nested": [25, 26]}]}}]}
    tables = flat.flatten_all(parsed(spark, doc), POSTS2)
    tests = tables["posts2_comment_struct_tests"].orderBy("posts2_comments_idx", "idx").collect()
    assert [(r.v, r.idx) for r in tests] == [(1, 1), (2, 2), (3, 1)]
    nested = tables["posts2_comment_struct_test_nested"].orderBy("nested").collect()
    assert [(r.nested, r.idx) for r in nested] == [(20, 1), (23, 1), (24, 2), (25, 1), (26, 2)]
    broken = flat.flatten_all(parsed(spark, doc | {"comments": "error in data"}), POSTS2)
    assert broken["posts2_comments"].count() == 0 and broken["posts2"].count() == 1


def test_object_ids_given_plainly(spark):
    plan = FlattenPlan("t", {"_id": OID, "s": {"_id": OID}})
    assert rows(flat.flatten(parsed(spark, {"_id": {"oid": "a", "bsontype": 7}, "s": {"_id": {"$oid": "b", "bsontype": 3}}}), plan, "t")) == [(7, "a", 7, "b")]


def test_strict_types_and_errors(spark):
    plan = FlattenPlan("t", {"_id": "INT", "s": "STRING", "n": "TINYINT", "l": "LONG", "a": ["INT"], "o": [{"x": "INT"}]})
    docs = parsed(spark, {"_id": 1, "s": 2, "n": 40000, "l": {"$numberLong": "12345678901"}, "a": [1, None, 2.5, "x"], "o": [{}, {"x": "bad"}, 7]}, "no json", {"_id": 2, "s": {}, "extra": 1})
    assert rows(flat.flatten(docs, plan, "t"), ["id"]) == [(1, 12345678901, None, None), (2, None, None, None)]
    assert rows(flat.flatten(docs, plan, "t_a"), ["idx"]) == [(1, 1, 1), (None, 1, 3), (None, 1, 4)]
    assert rows(flat.flatten(docs, plan, "t_o"), ["idx"]) == [(1, None, 1), (1, None, 2), (1, None, 3)]
    errors = {(r.table, r.column): r.errors for r in flat.type_errors(docs, plan).collect()}
    assert errors == {("t", "s"): 2, ("t", "n"): 1, ("t_a", "a"): 2, ("t_o", "x"): 1}


def test_partial_values(spark):
    value = spark.createDataFrame([("133", '[{"v": 12, "nested": [30]}, {"v": 13, "nested": [32, 31]}]')], "id string, v string").select("id", F.parse_json("v").alias("value"))
    tables = flat.flatten_partial(value, POSTS2, "comments.2.struct.tests")
    assert set(tables) == {"posts2_comment_struct_tests", "posts2_comment_struct_test_nested"}
    assert [(r.v, r.posts2_comments_idx, r.idx) for r in tables["posts2_comment_struct_tests"].orderBy("idx").collect()] == [(12, 3, 1), (13, 3, 2)]
    assert flat.flatten_partial(value, POSTS2, "none.1") == {}


def test_rebuild(spark):
    tables = flat.flatten_all(parsed(spark, DOC, {"_id": oid("2" * 24)}), INSERTS)
    back = {r.id_oid: r for r in nest.rebuild(tables, INSERTS).collect()}
    comments = back["56b8f05cf9fcee1b00000010"].a_insert_comments
    assert [c.body for c in comments] == [None, "body2"] and comments[0].a_insert_comment_items[0].data == "1" and comments[1].a_insert_comment_slugs is None
    assert back["2" * 24].a_insert_comments is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet=st.one_of(st.sampled_from("\\\t\n\rNtnr"), st.characters(exclude_categories=["Cs"], exclude_characters="\0")))), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=12))
def test_text_round_trip(spark, data):
    df = spark.createDataFrame(data, "a string, b int")
    lines = codec.encode(df)
    assert not lines.where(F.col("value").rlike("[\n\r]")).count()
    assert sorted(map(tuple, codec.decode(lines, df.schema).collect()), key=str) == sorted(data, key=str)


def test_initial_load(spark, tmp_path):
    texts = spark.createDataFrame([(json.dumps(DOC),), (json.dumps(DOC),), ("bad",), (json.dumps({"_id": oid("2" * 24), "body": "\\N"}),)], "doc string")
    for kind in ("parquet", "tsv"):
        counts = load.init_load(texts, INSERTS, f"{tmp_path}/{kind}", file_format=kind)
        assert counts == {"a_inserts": 2, "a_insert_comments": 2, "a_insert_comment_items": 2, "a_insert_comment_slugs": 1}
    back = read_tsv(spark, f"{tmp_path}/tsv/a_inserts", INSERTS.struct("a_inserts"))
    assert rows(back, ["id_oid"]) == rows(spark.read.parquet(f"{tmp_path}/parquet/a_inserts"), ["id_oid"])
    assert "CREATE TABLE" in spark.read.text(f"{tmp_path}/tsv/_ddl").collect()[1].value


def test_reading_and_finding(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"_id": 1, "a": {"b": 5}, "s": "x"}\n\n{"_id": 2, "a": {"b": "5"}}\n{"_id": 3, "a": {"b": 7}}\n')
    docs = read_documents(spark, str(tmp_path / "d.json"))
    plan = FlattenPlan("t", {"_id": "INT", "a": {"b": "INT"}, "s": "STRING"})
    ids = lambda q: [r.id for r in flat.flatten(find_documents(docs, q), plan, "t").orderBy("id").collect()]
    assert ids({"a.b": 5}) == [1] and ids({"a.b": {"$gte": 5}}) == [1, 3] and ids({"$or": [{"_id": 2}, {"s": "x"}]}) == [1, 2]
    assert ids({"s": {"$exists": False}}) == [2, 3] and ids({"_id": {"$nin": [1]}}) == [2, 3] and ids({"$nor": [{"_id": 1}]}) == [2, 3] and ids({"s": None}) == [2, 3]
    with pytest.raises(ValueError):
        find_documents(docs, {"a": {"$where": "1"}})
    wanted = spark.createDataFrame([(1,), (3,)], "id int")
    chosen = tables_by_ids(docs, wanted, plan)
    assert sorted(r.id for r in chosen["t"].collect()) == [1, 3]
    assert [r.id for r in rows_by_ids(flat.flatten_all(docs, plan), wanted, plan)["t"].collect()] == [1, 3]


def test_load_keeps_documents_without_an_id(spark, tmp_path):
    plan = parse_schema('{"_id": "INT", "v": "STRING"}', "things")
    texts = spark.createDataFrame([(x,) for x in ('{"_id": 1, "v": "a"}', '{"_id": 1, "v": "b"}', '{"v": "c"}', '{"_id": null, "v": "d"}', '{"_id": "x", "v": 5}', "{broken")], "doc string")
    assert load.init_load(texts, plan, str(tmp_path)) == {"things": 4}
    found = spark.read.parquet(f"{tmp_path}/things")
    assert sorted((str(r.id), str(r.v)) for r in found.collect()) == [("1", "a"), ("None", "None"), ("None", "c"), ("None", "d")]
    assert {r.value for r in spark.read.text(f"{tmp_path}/_stats").collect()} == {"things 4", "error json 1", "error things.id 1", "error things.v 1"}
