"""Queries over the relational engine, by name, with their SQL.

Documents and log records are made from the driver's tables as JSON texts and then go through the engine. Times are
given as microseconds, so that results do not depend on a session's time zone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.functions import codec, find
from docrel.operators import apply, load, nest, oplog, status, verify
from docrel.operators import flatten as flat
from docrel.plans import ddl, naming
from docrel.plans.schema import FlattenPlan
from docrel.session import ship, work_folder

_ENTRIES: dict[str, tuple[Callable, str | None]] = {}


def entry(sql: str | None = None):
    def put(f: Callable) -> Callable:
        _ENTRIES[f.__name__] = (f, sql)
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: f for n, (f, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for n, (_, s) in _ENTRIES.items() if s}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents -----------------------------------------------------------------------------------------------------

OID = {"oid": "STRING", "bsontype": "INT"}
LINE = {"number": "INT", "part": "LONG", "supplier": "LONG", "qty": "DOUBLE", "price": "DOUBLE", "flag": "STRING", "shipped": "TIMESTAMP"}
ORDERS = FlattenPlan("orders", {"_id": "LONG", "customer": "LONG", "status": "STRING", "total": "DOUBLE", "priority": "STRING", "placed": "TIMESTAMP", "lines": [LINE]})
CUSTOMERS = FlattenPlan("customers", {"_id": "LONG", "name": "STRING", "orders": [{"key": "LONG", "total": "DOUBLE", "lines": [{"number": "INT", "part": "LONG", "qty": "DOUBLE"}]}]})
VECTORS = FlattenPlan("vectors", {"_id": "LONG", "label": "INT", "values": ["DOUBLE"]})
SUPPLIERS = FlattenPlan("suppliers", {"_id": "LONG", "name": "STRING", "nation": {"name": "STRING", "region": {"name": "STRING"}}})
TAGGED = FlattenPlan("tagged", {"_id": OID, "owner": {"_id": OID}, "status": "STRING"})
MIXED = FlattenPlan("mixed", {"_id": "LONG", "s": "STRING", "n": "INT", "big": "LONG", "d": "DOUBLE", "b": "BOOLEAN", "when": "TIMESTAMP", "tags": ["INT"]})
USERS = FlattenPlan("users", {"_id": "LONG", "value": "DOUBLE", "kind": "STRING", "info": {"a": "LONG", "b": "STRING"}, "tags": ["LONG"]})


def date(c: str) -> Column:
    return F.struct(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("$date"))


def line_struct() -> Column:
    return F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), F.col("l_quantity").alias("qty"),
                    F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"), date("l_shipdate").alias("shipped"))


def lines_by_order(spark: SparkSession, sf: str, line: Column | None = None) -> DataFrame:
    return read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line_struct() if line is None else line)).alias("lines"))


def order_docs(spark: SparkSession, sf: str) -> DataFrame:
    met = read(spark, sf, "orders").join(lines_by_order(spark, sf), "o_orderkey", "left")
    body = F.struct(F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
                    F.col("o_orderpriority").alias("priority"), date("o_orderdate").alias("placed"), "lines")
    return met.select(F.col("o_orderkey").alias("key"), F.to_json(body).alias("doc"))


def parsed(docs: DataFrame) -> DataFrame:
    return flat.parse(docs.select("doc"))


def plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.unix_micros(n) for n, t in df.dtypes if t == "timestamp"})


ROOT_SQL = """SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status, o_totalprice AS total, o_orderpriority AS priority,
 epoch_us(o_orderdate) AS placed FROM orders"""
NUMBERED = """SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate) AS idx
 FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders) ON l_orderkey = o_orderkey"""
LINES_SQL = f"""SELECT l_orderkey AS orders_id, l_linenumber AS number, l_partkey AS part, l_suppkey AS supplier, l_quantity AS qty, l_extendedprice AS price,
 l_returnflag AS flag, epoch_us(l_shipdate) AS shipped, idx FROM ({NUMBERED})"""


@entry(ROOT_SQL)
def flatten_root(spark, sf):
    return plain_times(flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "orders"))


@entry(LINES_SQL)
def flatten_child_l1(spark, sf):
    return plain_times(flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines"))


def customer_docs(spark: SparkSession, sf: str) -> DataFrame:
    line = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("qty"))
    order = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"), "lines")
    orders = read(spark, sf, "orders").join(lines_by_order(spark, sf, line), "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array_sort(F.collect_list(order)).alias("orders"))
    body = F.struct(F.col("c_custkey").alias("_id"), F.col("c_name").alias("name"), "orders")
    return read(spark, sf, "customer").join(orders, "c_custkey", "left").select(F.to_json(body).alias("doc"))


@entry("""WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT o_custkey AS customers_id, l_linenumber AS number, l_partkey AS part, l_quantity AS qty, p AS customers_orders_idx,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS idx FROM lineitem JOIN o ON l_orderkey = o_orderkey""")
def flatten_child_l2(spark, sf):
    return flat.flatten(parsed(customer_docs(spark, sf)), CUSTOMERS, "customer_order_lines")


@entry("""SELECT vec_id AS vectors_id, CAST(v AS DOUBLE) AS "values", i AS idx FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)""")
def flatten_scalar_array(spark, sf):
    body = F.struct(F.col("vec_id").alias("_id"), "label", F.col("embedding").cast("array<double>").alias("values"))
    return flat.flatten(parsed(read(spark, sf, "embeddings").select(F.to_json(body).alias("doc"))), VECTORS, "vector_values")


@entry("SELECT s_suppkey AS id, s_name AS name, n_name AS nation_name, r_name AS nation_region_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def flatten_struct_columns(spark, sf):
    met = read(spark, sf, "supplier").join(read(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = F.struct(F.col("s_suppkey").alias("_id"), F.col("s_name").alias("name"), F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("nation"))
    return flat.flatten(parsed(met.select(F.to_json(body).alias("doc"))), SUPPLIERS, "suppliers")


@entry("SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def flatten_empty_arrays(spark, sf):
    docs = parsed(order_docs(spark, sf))
    roots, lines = flat.flatten(docs, ORDERS, "orders"), flat.flatten(docs, ORDERS, "order_lines")
    return roots.join(lines.select(F.col("orders_id").alias("id")), "id", "left_anti").select("id")


@entry("""SELECT left(md5(CAST(o_orderkey AS VARCHAR)), 24) AS id_oid, CAST(7 AS INTEGER) AS id_bsontype, left(md5(CAST(o_custkey AS VARCHAR)), 24) AS owner_id_oid,
 CAST(7 AS INTEGER) AS owner_id_bsontype, o_orderstatus AS status FROM orders""")
def flatten_objectid(spark, sf):
    oid = lambda c: F.struct(F.substring(F.md5(F.col(c).cast("string")), 1, 24).alias("$oid"))
    body = F.struct(oid("o_orderkey").alias("_id"), F.struct(oid("o_custkey").alias("_id")).alias("owner"), F.col("o_orderstatus").alias("status"))
    return flat.flatten(parsed(read(spark, sf, "orders").select(F.to_json(body).alias("doc"))), TAGGED, "tagged")


def mixed_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One field set in eight ways by ``o_orderkey % 8``: only some of them fit a type."""
    ways = ('"text"', "5", "5.5", "true", "{}", "null", "3000000000", '{"$date":"2020-01-02T03:04:05.678Z"}')
    k = F.col("o_orderkey")
    value = F.get(F.array(*[F.lit(w) for w in ways]), (k % 8).cast("int"))
    fields = [F.concat(F.lit(f'"{n}":'), value) for n in ("s", "n", "big", "d", "b", "when")]
    tags = F.when(k % 3 == 0, F.lit('"tags":"none"')).when(k % 3 == 1, F.lit('"tags":[1,"x",null,4]')).otherwise(F.lit('"tags":[]'))
    return read(spark, sf, "orders").select(F.concat(F.lit('{"_id":'), k, F.lit(","), F.concat_ws(",", *fields, tags), F.lit(',"extra":{"s":1}}')).alias("doc"))


@entry("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 = 0 THEN 'text' END AS s, CAST(CASE WHEN o_orderkey % 8 = 1 THEN 5 END AS INTEGER) AS n,
 CAST(CASE o_orderkey % 8 WHEN 1 THEN 5 WHEN 6 THEN 3000000000 END AS BIGINT) AS big, CAST(CASE o_orderkey % 8 WHEN 1 THEN 5 WHEN 2 THEN 5.5 WHEN 6 THEN 3000000000 END AS DOUBLE) AS d,
 CASE WHEN o_orderkey % 8 = 3 THEN true END AS b, CASE WHEN o_orderkey % 8 = 7 THEN 1577934245678000 END AS "when" FROM orders""")
def strict_types(spark, sf):
    return plain_times(flat.flatten(parsed(mixed_docs(spark, sf)), MIXED, "mixed"))


@entry("""SELECT o_orderkey AS mixed_id, CAST(v AS INTEGER) AS tags, CAST(i AS BIGINT) AS idx FROM orders, (VALUES (1, 1), (NULL, 2), (4, 4)) t(v, i) WHERE o_orderkey % 3 = 1""")
def array_type_mismatch(spark, sf):
    return flat.flatten(parsed(mixed_docs(spark, sf)), MIXED, "mixed_tags")


@entry("""SELECT 'mixed' AS "table", c AS "column", count(*) AS errors FROM orders, (VALUES ('s', [0, 5]), ('n', [1, 5]), ('big', [1, 5, 6]), ('d', [1, 2, 5, 6]), ('b', [3, 5]), ('when', [5, 7])) t(c, fits)
 WHERE NOT list_contains(fits, CAST(o_orderkey % 8 AS INTEGER)) GROUP BY c UNION ALL SELECT 'mixed_tags', 'tags', count(*) FROM orders WHERE o_orderkey % 3 = 1 HAVING count(*) > 0""")
def type_error_counts(spark, sf):
    return flat.type_errors(parsed(mixed_docs(spark, sf)), MIXED)


@entry("SELECT unnest(['b', 'big', 'd', 'id', 'n', 's', 'when']) AS name WHERE (SELECT count(*) FROM orders) > 0")
def unknown_fields_dropped(spark, sf):
    rows = flat.flatten(parsed(mixed_docs(spark, sf)), MIXED, "mixed")
    return rows.limit(1).select(F.explode(F.array(*[F.lit(c) for c in rows.columns])).alias("name"))


# --- names and statements: lists of fixed size, computed when the plan is made -----------------------------------------


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def literal_sql(rows: list[tuple], names: list[str]) -> str:
    cell = lambda v: "NULL" if v is None else f"CAST({v} AS BIGINT)" if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) t({', '.join(names)})"


@entry(literal_sql([("orders", "customer", "bigint"), ("orders", "id", "bigint"), ("orders", "placed", "TIMESTAMP WITH TIME ZONE"), ("orders", "priority", "TEXT"), ("orders", "status", "TEXT"),
                    ("orders", "total", "FLOAT8"), ("order_lines", "flag", "TEXT"), ("order_lines", "number", "INTEGER"), ("order_lines", "orders_id", "bigint"), ("order_lines", "part", "bigint"),
                    ("order_lines", "price", "FLOAT8"), ("order_lines", "qty", "FLOAT8"), ("order_lines", "shipped", "TIMESTAMP WITH TIME ZONE"), ("order_lines", "supplier", "bigint"),
                    ("order_lines", "idx", "BIGINT")], ["table_name", "column_name", "sql_type"]))
def schema_tables(spark, sf):
    return values(spark, [(t, c, k) for t in ORDERS.tables for c, k in ddl.column_types(ORDERS, t).items()], "table_name string, column_name string, sql_type string")


@entry(literal_sql([
    ('CREATE INDEX "ia_customer_order_lines" ON "customer_order_lines" ("customers_id", "customers_orders_idx", "idx");',),
    ('CREATE INDEX "ib_customer_order_lines" ON "customer_order_lines" ("customers_id", "customers_orders_idx");',),
    ('CREATE INDEX "ic_customer_order_lines" ON "customer_order_lines" ("customers_id");',)], ["statement"]))
def schema_index_ddl(spark, sf):
    return values(spark, [(ddl.create_index(CUSTOMERS, "customer_order_lines", k),) for k in ddl.INDEXES], "statement string")


NAMES = ["_id", "_ _3_test", "_test_", "name", "__A1", "123", ""]


@entry("SELECT name, nullif(regexp_replace(name, '^[^A-Za-z]+', ''), '') AS cleaned FROM (SELECT unnest(['_id', '_ _3_test', '_test_', 'name', '__A1', '123', '']) AS name)")
def name_cleaning(spark, sf):
    return values(spark, [(n, naming.clean_name(n)) for n in NAMES], "name string, cleaned string")


PATHS = ["persons.relatives.2.contacts.3.phones.4", "persons.1.relatives", "persons", "posts.comments.struct.tests", "a.0.b.1.c"]


@entry(literal_sql([(PATHS[0], "person_relative_contact_phones", "persons_relatives_contacts_phones_idx"), (PATHS[1], "person_relatives", "persons_relatives_idx"), (PATHS[2], "persons", "persons_idx"),
                    (PATHS[3], "post_comment_struct_tests", "posts_comments_struct_tests_idx"), (PATHS[4], "a_b_c", "a_b_c_idx")], ["path", "table_name", "index_column"]))
def table_names_from_path(spark, sf):
    return values(spark, [(p, naming.table_name(p), naming.index_column(p)) for p in PATHS], "path string, table_name string, index_column string")


@entry(literal_sql([(PATHS[0], "persons", None), (PATHS[0], "relatives", 2), (PATHS[0], "contacts", 3), (PATHS[0], "phones", 4), (PATHS[1], "persons", 1), (PATHS[1], "relatives", None),
                    (PATHS[2], "persons", None), (PATHS[3], "posts", None), (PATHS[3], "comments", None), (PATHS[3], "struct", None), (PATHS[3], "tests", None), (PATHS[4], "a", 0), (PATHS[4], "b", 1), (PATHS[4], "c", None)],
                   ["path", "name", "position"]))
def path_components(spark, sf):
    return values(spark, [(p, n, i) for p in PATHS for n, i in naming.components(p)], "path string, name string, position long")


@entry(literal_sql([(PATHS[0], "persons_relatives", 3), (PATHS[0], "persons_relatives_contacts", 4), (PATHS[0], "persons_relatives_contacts_phones", 5), (PATHS[1], "persons", 2), (PATHS[4], "a", 1), (PATHS[4], "a_b", 2)],
                   ["path", "array_name", "position"]))
def path_indexes(spark, sf):
    return values(spark, [(p, n, i) for p in PATHS for n, i in naming.index_map(p).items()], "path string, array_name string, position long")


# --- load -------------------------------------------------------------------------------------------------------------


@entry("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def dedup_first(spark, sf):
    rows = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return load.first_of_each(rows, ["l_orderkey", "l_linenumber"], F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"))


_ESCAPED = "replace(replace(replace(replace(text, chr(92), chr(92)||chr(92)), chr(9), chr(92)||'t'), chr(10), chr(92)||'n'), chr(13), chr(92)||'r')"


@entry(f"SELECT CAST(doc_id AS VARCHAR) || chr(9) || coalesce({_ESCAPED}, chr(92)||'N') || chr(9) || coalesce(lang, chr(92)||'N') AS line FROM documents")
def tsv_encode(spark, sf):
    return codec.encode(read(spark, sf, "documents").select("doc_id", "text", "lang"), "line")


@entry("SELECT doc_id, text, lang, source, n_chars FROM documents")
def tsv_roundtrip(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return codec.decode(codec.encode(docs), docs.schema)


@entry(f"""SELECT doc_id, CAST(floor(coalesce(sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000) AS BIGINT) AS chunk
 FROM (SELECT doc_id, strlen(CAST(doc_id AS VARCHAR) || chr(9) || {_ESCAPED}) + 1 AS n FROM documents WHERE doc_id IS NOT NULL)""")
def tsv_chunks(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "text").where("doc_id IS NOT NULL")
    line = F.concat_ws("\t", *[F.coalesce(codec.escape(F.col(c)), F.lit(codec.NULL)) for c in docs.columns])
    return load.chunk_numbers(docs.select("doc_id", line.alias("value")), "doc_id", chunk_bytes=100_000).select("doc_id", "chunk")


@entry("SELECT 'orders' AS \"table\", count(*) AS n FROM orders UNION ALL SELECT 'order_lines', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def load_stats(spark, sf):
    return flat.row_counts(flat.flatten_all(parsed(order_docs(spark, sf)), ORDERS))


# --- find -------------------------------------------------------------------------------------------------------------


@entry("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 7")
def find_by_id(spark, sf):
    return read(spark, sf, "orders").where(find.condition({"o_orderkey": 7})).select("o_orderkey", "o_totalprice")


@entry("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 5, 7, 32, 100)")
def find_by_id_list(spark, sf):
    return read(spark, sf, "orders").where(find.condition({"$or": [{"o_orderkey": k} for k in (1, 5, 7, 32, 100)]})).select("o_orderkey", "o_totalprice")


@entry("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice >= 100000 AND o_totalprice < 250000 AND (o_orderstatus IN ('F', 'P') OR o_orderpriority <> '1-URGENT')
 AND NOT (o_custkey > 1000)""")
def find_filter(spark, sf):
    query = {"o_totalprice": {"$gte": 100000, "$lt": 250000}, "$or": [{"o_orderstatus": {"$in": ["F", "P"]}}, {"o_orderpriority": {"$ne": "1-URGENT"}}], "o_custkey": {"$not": {"$gt": 1000}}}
    return read(spark, sf, "orders").where(find.condition(query)).select("o_orderkey", "o_orderstatus", "o_totalprice")


@entry("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'O'")
def find_projection(spark, sf):
    from docrel.functions.extract import strict
    from docrel.sources.readers import find_documents

    found = find_documents(parsed(order_docs(spark, sf)), {"total": {"$gt": 200000}, "status": "O"}, ["_id", "status"])
    return found.select(strict(F.col("_id"), "LONG").alias("id"), strict(F.col("status"), "STRING").alias("status"))


@entry(f"SELECT l_orderkey AS orders_id, l_linenumber AS number, l_partkey AS part, idx FROM ({NUMBERED}) WHERE l_orderkey = 7 AND idx = 3")
def find_by_path(spark, sf):
    predicates = find.path_predicates(ORDERS, "lines.2", 7)["order_lines"]
    return flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines").where(find.where(predicates)).select("orders_id", "number", "part", "idx")


@entry(literal_sql([("order_lines", "(idx=(%s)) and (orders_id=(%s))")], ["table_name", "template"]))
def where_templates(spark, sf):
    return values(spark, [(t, find.where_text(p)[0]) for t, p in find.path_predicates(ORDERS, "lines.2", 7).items()], "table_name string, template string")


@entry(f"SELECT l_orderkey AS orders_id, l_partkey AS part, idx FROM ({NUMBERED}) WHERE l_orderkey % 100 = 0")
def lookup_source_ids(spark, sf):
    from docrel.sources.readers import tables_by_ids

    ids = read(spark, sf, "orders").where("o_orderkey % 100 = 0").select(F.col("o_orderkey").alias("id"))
    return tables_by_ids(parsed(order_docs(spark, sf)), ids, ORDERS)["order_lines"].select("orders_id", "part", "idx")


@entry(f"SELECT l_orderkey AS orders_id, l_partkey AS part, idx FROM ({NUMBERED}) WHERE l_orderkey % 100 = 0")
def lookup_target_ids(spark, sf):
    from docrel.sources.readers import rows_by_ids

    ids = read(spark, sf, "orders").where("o_orderkey % 100 = 0").select(F.col("o_orderkey").alias("id"))
    lines = flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines").select("orders_id", "part", "idx")
    return rows_by_ids({"order_lines": lines}, ids, ORDERS)["order_lines"]


@entry(literal_sql([('DROP TABLE IF EXISTS "vectors";',), ('CREATE TABLE IF NOT EXISTS "vectors" ("id" bigint, "label" INTEGER);',), ('DROP TABLE IF EXISTS "vector_values";',),
                    ('CREATE TABLE IF NOT EXISTS "vector_values" ("values" FLOAT8, "vectors_id" bigint, "idx" BIGINT);',)], ["statement"]))
def schema_ddl(spark, sf):
    return values(spark, [(x,) for x in ddl.script(VECTORS).split("\n")], "statement string")


# --- the log ----------------------------------------------------------------------------------------------------------


def records(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as log records of two shards about one document a user."""
    e, kind, i = read(spark, sf, "events"), F.col("event_type"), F.col("event_id")
    micros = F.expr(MICROS)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    value = F.coalesce(F.col("value").cast("string"), F.lit("null"))
    insert = text('{"_id":', F.col("user_id"), ',"value":', value, ',"kind":"', kind, '","info":{"a":', i % 10, ',"b":"x', i % 7, '"},"tags":[', i, "]}")
    view = text('{"$set":{"value":', value, ',"kind":"v', i % 5, '"}}')
    click = text('{"$set":{"info":{"a":', i % 10, '},"tags":[', i, ",", F.col("user_id"), "]}}")
    purchase = text('{"$set":{"tags.1":', i, '},"$unset":{"value":""}}')
    op = F.when(kind == "signup", "i").when(kind == "error", "d").otherwise("u")
    o = F.when(kind == "signup", insert).when(kind == "error", text('{"_id":', F.col("user_id"), "}")).when(kind == "view", view).when(kind == "click", click).otherwise(purchase)
    return e.select(
        text("s", i % 2).alias("shard"), F.struct(F.floor(micros / 1000000).alias("t"), F.pmod(micros, F.lit(1000000)).cast("long").alias("i")).alias("ts"),
        op.alias("op"), F.lit("app.users").alias("ns"), F.lit("users").alias("collection"), F.col("user_id").cast("string").alias("rec_id"), o.alias("o"),
        text('{"_id":', F.col("user_id"), "}").alias("o2"), (i % 97 == 0).alias("from_migrate"))


#: Microseconds of a time without zone.
MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))"
LOG = """SELECT event_id, user_id, value, event_type, 's' || (event_id % 2) AS shard, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS t, epoch_us(ts) % 1000000 AS i, event_id % 97 = 0 AS moved,
 CASE event_type WHEN 'signup' THEN 'i' WHEN 'error' THEN 'd' ELSE 'u' END AS op, row_number() OVER (ORDER BY ts, event_id % 2, event_id) AS n FROM events"""
POINT = (1705000000, 250000)


@entry(f"SELECT shard, t, i, op, CAST(user_id AS VARCHAR) AS rec_id FROM ({LOG}) WHERE t > {POINT[0]} OR (t = {POINT[0]} AND i > {POINT[1]})")
def oplog_after_ts(spark, sf):
    return records(spark, sf).where(find.after(POINT)).select("shard", "ts.t", "ts.i", "op", "rec_id")


@entry(f"SELECT shard, t, i, op, CAST(user_id AS VARCHAR) AS rec_id FROM ({LOG}) WHERE (t > {POINT[0]} OR (t = {POINT[0]} AND i > {POINT[1]})) AND user_id IN (1, 2, 3, 10)")
def oplog_filter_ids(spark, sf):
    return records(spark, sf).where(find.oplog_of(POINT, "app.users", ["1", "2", "3", "10"])).select("shard", "ts.t", "ts.i", "op", "rec_id")


@entry(f"SELECT CAST(user_id AS VARCHAR) AS rec_id, shard, t, i, row_number() OVER (PARTITION BY user_id ORDER BY t, i, shard) AS place FROM ({LOG}) WHERE NOT moved")
def oplog_merge_order(spark, sf):
    from pyspark.sql import Window

    every = records(spark, sf)
    merged = oplog.merge([oplog.own(every.where(F.col("shard") == s)) for s in ("s0", "s1")])
    return merged.select("rec_id", "shard", "ts.t", "ts.i", F.row_number().over(Window.partitionBy("rec_id").orderBy(oplog.order())).cast("long").alias("place"))


@entry(f"SELECT shard, max(us) // 1000000 AS t, max(us) % 1000000 AS i FROM ({LOG}) WHERE NOT moved GROUP BY shard UNION ALL SELECT 's9', 5, 6")
def oplog_high_water(spark, sf):
    marks = oplog.high_water(records(spark, sf), {"s0": None, "s9": (5, 6)})
    return values(spark, [(s, *p) for s, p in marks.items()], "shard string, t long, i long")


@entry(f"SELECT shard, max(us) // 1000000 AS t, max(us) % 1000000 AS i FROM ({LOG}) GROUP BY shard")
def oplog_latest_ts(spark, sf):
    return records(spark, sf).groupBy("shard").agg(F.max("ts").alias("ts")).select("shard", "ts.t", "ts.i")


@entry(f"SELECT DISTINCT 'users' AS collection, CAST(user_id AS VARCHAR) AS rec_id FROM ({LOG}) WHERE NOT moved")
def oplog_touched_ids(spark, sf):
    return oplog.touched(oplog.valid(records(spark, sf), ["users"]))


@entry(f"SELECT op, count(*) AS n FROM ({LOG}) WHERE NOT moved GROUP BY op")
def oplog_valid_ops(spark, sf):
    return oplog.valid(records(spark, sf), ["users"]).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


_RESET = f"log AS ({LOG}), own AS (SELECT * FROM log WHERE NOT moved), r AS (SELECT user_id, max(n) AS r, arg_max(op, n) AS last FROM own WHERE op <> 'u' GROUP BY user_id), live AS (SELECT own.*, r.r FROM own JOIN r ON own.user_id = r.user_id AND last = 'i' AND n >= r.r)"
_LAST = lambda name, value, types: f"{name} AS (SELECT user_id, {value} AS {name} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS k FROM live WHERE event_type IN ({types})) WHERE k = 1)"
FINAL_SQL = f"""WITH {_RESET}, {_LAST("v", "CASE WHEN event_type = 'purchase' THEN NULL ELSE value END", "'signup', 'view', 'purchase'")},
 {_LAST("kd", "CASE WHEN event_type = 'signup' THEN 'signup' ELSE 'v' || (event_id % 5) END", "'signup', 'view'")}, {_LAST("a", "event_id % 10", "'signup', 'click'")},
 {_LAST("b", "CASE WHEN event_type = 'signup' THEN 'x' || (event_id % 7) END", "'signup', 'click'")}
 SELECT user_id AS id, v AS value, kd AS kind, a AS info_a, b AS info_b FROM v JOIN kd USING (user_id) JOIN a USING (user_id) JOIN b USING (user_id)"""
ARRAY_SQL = f"""WITH {_RESET}, s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS k FROM live WHERE event_type IN ('signup', 'click')) WHERE k = 1),
 p AS (SELECT live.user_id, max(live.n) AS pn, arg_max(live.event_id, live.n) AS pe FROM live JOIN s ON live.user_id = s.user_id AND live.n > s.n WHERE live.event_type = 'purchase' GROUP BY live.user_id)
 SELECT user_id AS users_id, event_id AS tags, CAST(1 AS BIGINT) AS idx FROM s UNION ALL
 SELECT s.user_id, coalesce(pe, s.user_id), 2 FROM s LEFT JOIN p ON s.user_id = p.user_id WHERE pe IS NOT NULL OR s.event_type = 'click'"""
STATE = "collection string, rec_id string, doc string"


def final_docs(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return apply.next_state(spark.createDataFrame([], STATE), oplog.valid(records(spark, sf), ["users"]))


@entry(FINAL_SQL)
def cdc_final_state(spark, sf):
    return flat.flatten(parsed(final_docs(spark, sf)), USERS, "users")


@entry(ARRAY_SQL)
def cdc_array_state(spark, sf):
    return flat.flatten(parsed(final_docs(spark, sf)), USERS, "user_tags")


@entry(f"SELECT id, kind FROM ({FINAL_SQL})")
def cdc_set_scalar(spark, sf):
    return cdc_final_state(spark, sf).select("id", "kind")


@entry(f"SELECT id, value FROM ({FINAL_SQL})")
def cdc_unset(spark, sf):
    return cdc_final_state(spark, sf).select("id", "value")


@entry(f"SELECT id, info_a, info_b FROM ({FINAL_SQL})")
def cdc_set_struct(spark, sf):
    return cdc_final_state(spark, sf).select("id", "info_a", "info_b")


@entry(f"SELECT users_id, tags FROM ({ARRAY_SQL}) WHERE idx = 1")
def cdc_replace_array(spark, sf):
    return cdc_array_state(spark, sf).where("idx = 1").select("users_id", "tags")


@entry(f"SELECT users_id, tags FROM ({ARRAY_SQL}) WHERE idx = 2")
def cdc_set_element(spark, sf):
    return cdc_array_state(spark, sf).where("idx = 2").select("users_id", "tags")


@entry(f"WITH {_RESET} SELECT DISTINCT CAST(user_id AS VARCHAR) AS rec_id FROM live")
def cdc_insert_delete(spark, sf):
    return final_docs(spark, sf).select("rec_id")


@entry(FINAL_SQL.replace(", a AS info_a, b AS info_b", ""))
def cdc_columns(spark, sf):
    """Whole-column records without Python."""
    e = read(spark, sf, "events").where("event_id % 97 <> 0")
    kind, i = F.col("event_type"), F.col("event_id")
    order = F.struct("ts", i % 2, i)
    op = F.when(kind == "signup", "i").when(kind == "error", "d").otherwise("u")
    columns = {"value": (kind.isin("signup", "view", "purchase"), F.when(kind != "purchase", F.col("value"))),
               "kind": (kind.isin("signup", "view"), F.when(kind == "signup", kind).otherwise(F.concat(F.lit("v"), i % 5)))}
    return apply.fold_columns(e, ["user_id"], order, op, columns).withColumnRenamed("user_id", "id")


@entry(FINAL_SQL)
def stream_cdc_final_state(spark, sf):
    """The same state from a stream of files, batch by batch."""
    from docrel.streaming.cdc import ChangeStream

    ship(spark)
    folder = f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = records(spark, sf)
    # neighbours in time share a file, so that batches follow the order of the log
    source.repartitionByRange(4, "ts.t", "ts.i").write.parquet(f"{folder}/log")
    stream = ChangeStream(spark, f"{folder}/state", ["users"])
    feed = spark.readStream.schema(source.schema).parquet(f"{folder}/log")
    stream.start(feed, f"{folder}/checkpoint").awaitTermination()
    return flat.flatten(parsed(stream.documents()), USERS, "users")


# --- rows of arrays -----------------------------------------------------------------------------------------------------


@entry(f"""SELECT l_orderkey AS orders_id, l_linenumber AS number, l_partkey AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY idx) AS idx
 FROM ({NUMBERED}) WHERE NOT (l_partkey % 5 = 0)""")
def array_delete_shift(spark, sf):
    lines = flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines").select("orders_id", "number", "part", "idx")
    return flat.remove_elements(lines, F.col("part") % 5 == 0, ["orders_id"])


@entry(f"SELECT l_orderkey AS orders_id, l_linenumber AS number, idx + 100 AS idx FROM ({NUMBERED})")
def partial_insert_offset(spark, sf):
    lines = flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines").select("orders_id", "number", "idx")
    return flat.with_offsets(lines, {"idx": 100})


@entry("SELECT o_orderkey AS orders_id, CAST(o_custkey AS BIGINT) AS part, CAST(4 AS BIGINT) AS idx FROM orders WHERE o_orderkey % 50 = 0")
def partial_value(spark, sf):
    """A value set at ``lines.3``."""
    chosen = read(spark, sf, "orders").where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("id"), F.try_parse_json(F.to_json(F.struct(F.col("o_custkey").alias("part")))).alias("value"))
    return flat.flatten_partial(chosen, ORDERS, "lines.3")["order_lines"].select("orders_id", "part", "idx")


@entry(f"SELECT coalesce(max(idx), 0) AS max_idx FROM ({NUMBERED})")
def max_idx(spark, sf):
    return flat.max_positions(flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines"))


@entry("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders UNION ALL SELECT -o_orderkey, 'N' FROM orders WHERE o_orderkey % 100 = 0""")
def upsert_merge(spark, sf):
    target = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    changed = target.where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    new = target.where("o_orderkey % 100 = 0").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    return apply.upsert(target, changed.union(new), ["o_orderkey"])


@entry(f"""SELECT l_orderkey AS orders_id, count(*) AS n, CAST(sum(l_linenumber * idx) AS BIGINT) AS checksum FROM ({NUMBERED}) GROUP BY l_orderkey""")
def nest_roundtrip(spark, sf):
    lines = flat.flatten(parsed(order_docs(spark, sf)), ORDERS, "order_lines")
    nested = nest.nest(lines.select("orders_id", "number", "idx"), ["orders_id"], "idx", "lines")
    back = nested.select("orders_id", F.posexplode("lines").alias("p", "line"))
    return back.groupBy("orders_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("line.number") * (F.col("p") + 1)).cast("long").alias("checksum"))


# --- verification -------------------------------------------------------------------------------------------------------


def perturbed(orders: DataFrame) -> DataFrame:
    changed = orders.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")))
    return changed.unionByName(orders.where("o_orderkey % 13 = 0").withColumn("o_orderkey", -F.col("o_orderkey")))


_KEEP = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
COMPARE_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'missing_in_target' ELSE 'different' END AS reason FROM orders WHERE o_orderkey <> 0 AND (o_orderkey % 11 = 0 OR o_orderkey % 10 = 0)
 UNION ALL SELECT -o_orderkey, 'missing_in_source' FROM orders WHERE o_orderkey <> 0 AND o_orderkey % 13 = 0"""


@entry(COMPARE_SQL)
def compare_ids(spark, sf):
    orders = read(spark, sf, "orders").select(*_KEEP).where("o_orderkey <> 0")
    return verify.differing_ids(orders, perturbed(orders), "o_orderkey")


@entry(f"""SELECT CAST(abs(o_orderkey) % 3 AS BIGINT) AS ntry, reason AS collection, array_to_string(list_sort(list(DISTINCT CAST(o_orderkey AS VARCHAR))), ',') AS ids FROM ({COMPARE_SQL}) GROUP BY ALL""")
def failed_by_try(spark, sf):
    orders = read(spark, sf, "orders").select(*_KEEP).where("o_orderkey <> 0")
    failing = verify.differing_ids(orders, perturbed(orders), "o_orderkey").select(F.col("reason").alias("collection"), F.col("o_orderkey").cast("string").alias("rec_id"))
    tries = failing.withColumn("ntry", F.abs(F.col("rec_id").cast("long")) % 3)
    return verify.failed_by_try(failing, tries).select("ntry", "collection", F.array_join("ids", ",").alias("ids"))


@entry("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey <> 0")
def repair(spark, sf):
    orders = read(spark, sf, "orders").select(*_KEEP).where("o_orderkey <> 0")
    target = perturbed(orders)
    return verify.replace_ids(target, orders, verify.differing_ids(orders, target, "o_orderkey"), "o_orderkey")


# --- sync points and status ---------------------------------------------------------------------------------------------


@entry(f"""WITH log AS ({LOG}), own AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n) AS k, count(*) OVER (PARTITION BY user_id) AS m FROM log WHERE NOT moved)
 SELECT CAST(user_id AS VARCHAR) AS rec_id, CAST(m AS BIGINT) AS n_ops FROM own GROUP BY user_id, m""")
def sync_points(spark, sf):
    """Every document is found in step with its source by some suffix of its records."""
    from docrel.operators import sync

    ship(spark)
    own = oplog.valid(records(spark, sf), ["users"])
    empty = spark.createDataFrame([], STATE)
    located = sync.locate(empty, apply.next_state(empty, own), own)
    return located.where("start IS NOT NULL").select("rec_id", F.col("n_ops").cast("long").alias("n_ops"))


@entry(f"SELECT shard, max(t) AS t FROM ({LOG}) WHERE NOT moved GROUP BY shard")
def sync_align(spark, sf):
    from docrel.operators import sync

    points = oplog.own(records(spark, sf)).select("shard", "ts.t", "ts.i")
    return sync.align(points).select("shard", "t")


_RUNS = [(1, "load", 100, 200, 0, False), (2, "sync", 300, None, 1, None), (3, "sync", 300, 350, 1, False), (4, "apply", 400, 410, 2, True)]


def run_log(spark: SparkSession) -> DataFrame:
    return values(spark, _RUNS, "seq long, comment string, start long, stop long, status long, error boolean").withColumn("time_start", F.timestamp_seconds("start"))


@entry("SELECT CAST(4 AS BIGINT) AS seq, 'apply' AS comment")
def status_latest(spark, sf):
    return status.recent(run_log(spark)).select("seq", "comment")


@entry(literal_sql([(1, "load"), (3, "sync"), (4, "apply")], ["seq", "comment"]))
def status_update_log(spark, sf):
    return status.latest(run_log(spark)).select("seq", "comment")


@entry(literal_sql([(1, "sync"), (2, "stop"), (3, "apply"), (4, "stop")], ["seq", "step"]))
def status_state(spark, sf):
    from collections import namedtuple

    run = namedtuple("run", "status time_end error")
    return values(spark, [(n, status.next_step(run(s, stop, bool(e)))) for n, _, _, stop, s, e in _RUNS], "seq long, step string")


@entry(f"SELECT shard, 'Timestamp(' || t || ', ' || i || ')' AS text, t, i FROM ({LOG})")
def ts_codec(spark, sf):
    written = records(spark, sf).select("shard", codec.timestamp_text(F.col("ts")).alias("text"))
    return written.withColumn("back", codec.timestamp_value(F.col("text"))).select("shard", "text", "back.t", "back.i")
