"""The log: folds, whole scenarios, verification, versions, streams, sync points and the run log."""

import copy
import json
from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docrel.functions import codec
from docrel.operators import apply, oplog, status, sync, verify
from docrel.operators import flatten as flat
from docrel.plans.schema import FlattenPlan
from docrel.sources import config
from docrel.sources.store import VersionedStore
from docrel.streaming import cdc
from tests.test_plans import COMMENT, OID, POST, POSTS2

POSTS = FlattenPlan("posts", POST | {"comments": [COMMENT | {"tests": ["INT"]}]})
PLANS = {"posts": POSTS, "posts2": POSTS2}


def oid(n):
    return {"$oid": f"56b8da59f9fcee1b000000{n:02d}"}


def log(t, op, collection, o, o2=None, **more):
    return json.dumps({"ts": {"$timestamp": {"t": t, "i": more.pop("i", 1)}}, "op": op, "ns": f"db.{collection}", "o": o} | ({"o2": o2} if o2 else {}) | more)


@pytest.mark.parametrize(("state", "ops", "want"), [
    (None, [("i", {"_id": 1})], {"_id": 1}),
    (None, [("u", {"$set": {"a": 1}})], None),
    ({"_id": 1}, [("d", {"_id": 1})], None),
    ({"_id": 1}, [("u", {"$set": {"a.b": 2}})], {"_id": 1, "a": {"b": 2}}),
    ({"_id": 1, "a": {"b": 1, "c": 2}}, [("u", {"$set": {"a": {"b": 5}}})], {"_id": 1, "a": {"b": 5}}),
    ({"_id": 1}, [("u", {"$set": {"a.2.t.1": 101}})], {"_id": 1, "a": [None, None, {"t": [None, 101]}]}),
    ({"_id": 1, "a": [{"x": 1}]}, [("u", {"$set": {"a.0.x": 2, "a.1": {"x": 3}}})], {"_id": 1, "a": [{"x": 2}, {"x": 3}]}),
    ({"_id": 1, "a": [1, 2, 3]}, [("u", {"$unset": {"a.1": ""}})], {"_id": 1, "a": [1, None, 3]}),
    ({"_id": 1, "a": {"b": 1}, "c": 2}, [("u", {"$set": {"c": 3}, "$unset": {"a.b": "", "none.x": ""}})], {"_id": 1, "a": {}, "c": 3}),
    ({"_id": 1, "a": 1}, [("u", {"b": 2})], {"_id": 1, "b": 2}),
    ({"_id": 1, "a": "text"}, [("u", {"$set": {"a.b": 1}})], {"_id": 1, "a": {"b": 1}}),
])
def test_fold(state, ops, want):
    assert apply.fold(state, ops) == want


def test_gaps_are_bounded():
    with pytest.raises(ValueError):
        apply.fold({"a": []}, [("u", {"$set": {"a.99999999": 1}})])


@given(st.lists(st.tuples(st.sampled_from("iud"), st.integers(0, 3), st.integers(0, 9)), max_size=12))
def test_records_before_a_reset_do_not_matter(steps):
    ops = [(k, {"_id": 1, "a": v} if k == "i" else {"$set": {f"f{f}": v}} if k == "u" else {"_id": 1}) for k, f, v in steps]
    last = max((n for n, (k, _) in enumerate(ops) if k in "id"), default=0)
    start = {"_id": 1}
    assert apply.fold(copy.deepcopy(start), copy.deepcopy(ops)) == apply.fold(copy.deepcopy(start), copy.deepcopy(ops[last:]))


LOG = [
    log(1, "i", "posts", {"_id": oid(10), "title": "title3", "body": "body3"}),
    log(2, "i", "posts", {"_id": oid(7)}),
    log(3, "u", "posts", {"$set": {"comments": [{"_id": oid(18)}, {}]}}, {"_id": oid(7)}),
    log(4, "u", "posts", {"$set": {"comments.2.tests.1": 101}}, {"_id": oid(7)}),
    log(5, "u", "posts2", {"$set": {"body": "body4"}}, {"_id": 33}),
    log(7, "u", "posts", {"$set": {"comments.6": {"_id": oid(15), "body": "comment6"}}}, {"_id": oid(6)}),
    log(8, "d", "posts", {"_id": oid(6)}),
    log(9, "u", "posts", {"$set": {"comments": [{"_id": oid(18)}]}}, {"_id": oid(7)}),
    log(10, "u", "posts", {"$set": {"comments.2": {"_id": oid(19), "body": "c2"}}}, {"_id": oid(7)}),
    log(12, "u", "posts", {"$set": {"comments": [{"_id": oid(18)}, {"_id": oid(26)}]}}, {"_id": oid(7)}),
    log(13, "u", "posts", {"$set": {"title": "sada", "unknown": 1}}, {"_id": oid(10)}),
    log(18, "i", "posts2", {"_id": 77, "comments": [{"body": {}}]}),
    log(19, "i", "posts", {"_id": oid(99)}, fromMigrate=True), log(20, "n", "posts", {"msg": "x"}), log(21, "i", "others", {"_id": 1}), "broken",
]
SOURCE = [("posts", oid(10)["$oid"], {"_id": oid(10), "title": "sada", "body": "body3", "elsewhere": [1]}), ("posts", oid(7)["$oid"], {"_id": oid(7), "comments": [{"_id": oid(18)}, {"_id": oid(26)}]}),
          ("posts2", "33", {"_id": 33, "title": "t", "body": "body4"}), ("posts2", "77", {"_id": 77, "comments": [{}]})]
BEFORE = [("posts2", "33", json.dumps({"_id": 33, "title": "t", "body": "old"}))]
STATE = "collection string, rec_id string, doc string"


@pytest.fixture(scope="module")
def records(spark):
    half = len(LOG) // 2
    parts = [spark.createDataFrame([(x,) for x in p], "value string") for p in (LOG[::2], LOG[1::2])]
    assert half
    return oplog.merge([oplog.parse(p, s) for p, s in zip(parts, ("s1", "s2"))])


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(c, i, json.dumps(d)) for c, i, d in SOURCE], STATE)


def test_parsed_records(records):
    found = records.where("collection = 'posts2'").orderBy("ts").collect()
    assert [(r.rec_id, r.op, r.ts.t) for r in found] == [("33", "u", 5), ("77", "i", 18)]
    assert oplog.valid(records, list(PLANS)).count() == 12
    marks = oplog.high_water(records, {"s3": (1, 2)})
    assert marks == {"s1": (21, 1), "s2": (20, 1), "s3": (1, 2)}
    assert oplog.since(records, {"s1": (12, 1), "s2": None}).where("shard = 's1' AND ts.t <= 12").count() == 0
    assert oplog.touched(records.where("collection = 'posts'")).count() == 5


def test_scenario_equals_source(spark, records, source):
    state = apply.next_state(spark.createDataFrame(BEFORE, STATE), oplog.valid(records, list(PLANS)))
    assert {r.rec_id for r in state.collect()} == {i for _, i, _ in SOURCE}
    touched = oplog.touched(oplog.valid(records, list(PLANS)))
    assert cdc.failing_ids(state, source, touched, PLANS).collect() == []


def test_differences_and_repair(spark):
    a = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 1), (3, "z", 1), (None, "n", 1)], "id int, v string, idx int")
    b = spark.createDataFrame([(1, "y", 2), (1, "x", 1), (2, "", 1), (4, "z", 1), (None, "n", 1)], "id int, v string, idx int")
    assert {tuple(r) for r in verify.differing_ids(a, b, "id").collect()} == {(2, "different"), (3, "missing_in_target"), (4, "missing_in_source")}
    fixed = verify.replace_ids(b, a, verify.differing_ids(a, b, "id"), "id")
    assert verify.differing_ids(a, fixed, "id").collect() == []
    docs = flat.parse(spark.createDataFrame([('{"_id": 1, "comments": [{"body": "b"}]}',)], "doc string"))
    good = flat.flatten_all(docs, POSTS2)
    bad = good | {"posts2_comments": good["posts2_comments"].where("false")}
    failing = verify.compare(good, bad, POSTS2).collect()
    assert [tuple(r) for r in failing] == [("1", "posts2_comments")]
    whole = verify.repair(bad, docs, POSTS2, spark.createDataFrame([(1,)], "id int"))
    assert verify.compare(good, whole, POSTS2).collect() == []


def test_versions(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), "a int")
    assert store.current() is None and store.read().count() == 0
    first = store.stage(spark.createDataFrame([(1,)], "a int"))
    assert store.read().count() == 0  # staged only
    assert store.commit(first, note="x") == 1 and store.current()["note"] == "x" and store.read().count() == 1
    for i in range(3):
        store.commit(store.stage(spark.createDataFrame([(i,)] * 2, "a int")))
    store.vacuum(keep=1)
    assert store.read().count() == 2 and len(list((tmp_path / "data").glob("[0-9a-f]*"))) == 1


def test_runs_commit_retry_and_repair(spark, records, source, tmp_path):
    store = VersionedStore(spark, f"{tmp_path}/a", cdc.STATE)
    before = spark.createDataFrame([(*r, None, None) for r in BEFORE], cdc.STATE)
    store.commit(store.stage(before))
    assert cdc.apply_and_verify(store, records, source, PLANS) == "ok"
    assert store.read().where("doc IS NOT NULL").count() == 4
    other = source.withColumn("doc", F.regexp_replace("doc", "sada", "other"))
    again = VersionedStore(spark, f"{tmp_path}/b", cdc.STATE)
    again.commit(again.stage(before))
    assert cdc.apply_and_verify(again, records, other, PLANS) == "retry" and again.current()["version"] == 1
    assert cdc.apply_and_verify(again, records, other, PLANS, attempt=1, repair=False) == "failed"
    assert cdc.apply_and_verify(again, records, other, PLANS, attempt=1) == "resync"
    assert again.read().where("doc LIKE '%other%'").count() == 1


def test_stream_batches_and_replays(spark, records, tmp_path):
    kept = records.where("ts.t < 22")
    kept.where("ts.t <= 7").coalesce(1).write.parquet(f"{tmp_path}/log/a")
    stream = cdc.ChangeStream(spark, f"{tmp_path}/state", list(PLANS))
    feed = lambda: spark.readStream.schema(records.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/log")
    stream.start(feed(), f"{tmp_path}/checkpoint").awaitTermination()
    first = stream.store.current()["version"]
    kept.where("ts.t > 7").coalesce(1).write.parquet(f"{tmp_path}/log/b")
    stream.start(feed(), f"{tmp_path}/checkpoint").awaitTermination()
    got = {(r.rec_id, r.doc) for r in stream.documents().collect()}
    want = {(r.rec_id, r.doc) for r in apply.next_state(spark.createDataFrame([], STATE), oplog.valid(kept, list(PLANS))).collect()}
    assert got == want and stream.store.current()["version"] == first + 1
    stream.batch(kept, stream.store.current()["batch"])  # a batch that was committed is left out
    assert stream.store.current()["version"] == first + 1
    stream.batch(kept, 99)  # old records change nothing
    assert {(r.rec_id, r.doc) for r in stream.documents().collect()} == want


def test_sync_points(spark):
    own = spark.createDataFrame([("s1", (t, 1), "u", "db.c", "c", "1", json.dumps({"$set": {"n": t}}), None, False) for t in (1, 2, 3)] +
                                [("s1", (5, 1), "i", "db.c", "c", "2", '{"_id": 2}', None, False)],
                                "shard string, ts struct<t:long,i:long>, op string, ns string, collection string, rec_id string, o string, o2 string, from_migrate boolean")
    loaded = spark.createDataFrame([("c", "1", '{"_id": 1, "n": 2}'), ("c", "2", '{"_id": 2}')], STATE)
    target = spark.createDataFrame([("c", "1", '{"n": 3, "_id": 1}'), ("c", "2", '{"_id": 2}')], STATE)
    located = sync.locate(loaded, target, own)
    assert {(r.rec_id, r.start, r.n_ops) for r in located.collect()} == {("1", 0, 3), ("2", 1, 1)}
    points = sync.align(located)
    assert [tuple(r) for r in points.collect()] == [("s1", 1, 1)]
    assert [r.ts.t for r in sync.due(own, located, points).collect()] == [1]


def test_run_log(spark, tmp_path):
    runs = status.RunLog(spark, f"{tmp_path}/log")
    assert runs.load_state() == status.LoadState.NO_RUN and status.next_step(runs.recent()) == "load"
    runs.init_load_start("None")
    assert runs.load_state() == status.LoadState.RUNNING and runs.load_state(datetime.now() + timedelta(hours=20)) == status.LoadState.HUNG
    assert status.next_step(runs.recent()) == "stop"
    runs.init_load_finish(False, 5)
    assert runs.load_state() == status.LoadState.OK and status.next_step(runs.recent()) == "sync"
    runs.oplog_sync_start("None")
    runs.oplog_sync_finish(1, 2, "Timestamp(1, 2)", False)
    assert runs.recent().ts == "Timestamp(1, 2)" and status.next_step(runs.recent()) == "apply"
    runs.oplog_use_start("Timestamp(1, 2)", 1)
    runs.oplog_resync_finish(1, 2, None, False)
    assert runs.recent().status == status.Status.OPLOG_RESYNC and runs.recent().ts == "Timestamp(1, 2)" and status.next_step(runs.recent()) == "sync"
    runs.oplog_use_start(None)
    runs.oplog_use_finish(0, 0, None, True)
    assert status.next_step(runs.recent()) == "stop" and status.latest(runs.read()).count() == 4


def test_points_as_text():
    points = {"b": (10, 2), "a": None}
    assert codec.points_text(points) == "None;Timestamp(10, 2)" and codec.points_value("None;Timestamp(10, 2)", ["a", "b"]) == points
    with pytest.raises(ValueError):
        codec.points_value("None", ["a", "b"])


def test_settings():
    text = "".join(f"[{s}]\n{s}-host=h{i}\n{s}-port={i}\n{s}-dbname=d\n{s}-user=u\n{s}-pass=p\n{s}-params=x=1\n" for i, s in enumerate(["mongo", "mongo-oplog-shard1-rs1", "mongo-oplog-shard1-rs2", "mongo-oplog-shard2-rs1"]))
    parser = config.read(text + "[psql]\npsql-host=ph\npsql-dbname=x\npsql-user=u\npsql-pass=%p\npsql-schema-name=sc\n")
    found = config.replicas(parser)
    assert {k: [s.host for s in v] for k, v in found.items()} == {"mongo-oplog-shard1": ["h1", "h2"], "mongo-oplog-shard2": ["h3"]}
    assert config.store_uri(found["mongo-oplog-shard1"]) == "mongodb://u:p@h1:1,h2:2/d?x=1"
    assert list(config.replicas(parser, "mongo")) == ["mongo"] and config.target_settings(parser).password == "%p" and config.value(parser, "psql:psql-host") == "ph"
    assert OID


def test_cycle_from_load_to_repair(spark, tmp_path):
    from docrel.streaming.cycle import run_once

    rows = [log(1, "i", "posts2", {"_id": 1, "title": "a"}), log(2, "u", "posts2", {"$set": {"title": "b"}}, {"_id": 1}), log(3, "u", "posts2", {"$set": {"body": "c"}}, {"_id": 1}), log(4, "i", "posts2", {"_id": 2})]
    every = oplog.parse(spark.createDataFrame([(x,) for x in rows], "value string"), "s1")
    docs = lambda *d: spark.createDataFrame([("posts2", str(x["_id"]), json.dumps(x)) for x in d], STATE)
    store, runs, plans = VersionedStore(spark, f"{tmp_path}/state", cdc.STATE), status.RunLog(spark, f"{tmp_path}/runs"), {"posts2": POSTS2}
    now = docs({"_id": 1, "title": "b", "body": "c"}, {"_id": 2})
    assert run_once(runs, store, every, now, plans, ["s1"]) == "load"
    runs.init_load_start("None")
    store.commit(store.stage(docs({"_id": 1, "title": "b"}, {"_id": 2}).selectExpr("*", "cast(null as long) t", "cast(null as long) i")))
    assert run_once(runs, store, every, now, plans, ["s1"]) == "stop"  # the load has not ended
    runs.init_load_finish(False)
    assert run_once(runs, store, every, now, plans, ["s1"]) == "sync ok"
    more = every.unionByName(oplog.parse(spark.createDataFrame([(log(9, "u", "posts2", {"$set": {"title": "z"}}, {"_id": 2}),)], "value string"), "s1"))
    now = docs({"_id": 1, "title": "b", "body": "c"}, {"_id": 2, "title": "z"})
    assert run_once(runs, store, more, now, plans, ["s1"]) == "apply ok" and runs.recent().ts == "Timestamp(9, 1)"
    assert {json.loads(r.doc).get("title") for r in store.read().collect()} == {"b", "z"}
    last = more.unionByName(oplog.parse(spark.createDataFrame([(log(10, "u", "posts2", {"$set": {"title": "y"}}, {"_id": 2}),)], "value string"), "s1"))
    other = docs({"_id": 1, "title": "b", "body": "c"}, {"_id": 2, "title": "x"})
    assert run_once(runs, store, last, other, plans, ["s1"]) == "apply retry" and runs.recent().attempt == 1
    assert run_once(runs, store, last, other, plans, ["s1"]) == "apply resync" and runs.recent().status == status.Status.OPLOG_RESYNC
    assert {json.loads(r.doc).get("title") for r in store.read().collect()} == {"b", "x"}


def test_any_split_of_a_log_gives_one_state(spark):
    import random

    rng, schema = random.Random(3), "shard string, ts struct<t:long,i:long>, op string, collection string, rec_id string, o string"
    rows = []
    for k in range(60):
        op = "iuuuud"[rng.randrange(6)]
        o = {"_id": 1, "a": k} if op == "i" else {"$set": {f"f{rng.randrange(3)}": k}} if op == "u" else {"_id": 1}
        rows += [(shard, (k // 2, 1), op, "c", str(rng.randrange(4)), json.dumps(o)) for shard in ("s0", "s1") if rng.random() < 0.7]
    unique = list({(r[0], r[1]): r for r in rows}.values())
    frame = lambda part: spark.createDataFrame(part, schema)
    docs = lambda state: {r.rec_id: r.doc for r in state.collect()}
    empty = spark.createDataFrame([], cdc.STATE)
    want = docs(cdc.next_version(empty, frame(unique)))
    plain = {r.rec_id: r.doc for r in apply.next_state(spark.createDataFrame([], STATE), frame(unique)).collect()}
    assert {k: v for k, v in want.items() if v} == plain and len(plain) > 1
    shuffled = rng.sample(unique, len(unique))
    lagging = [r for r in unique if r[0] == "s1"] + [r for r in unique if r[0] == "s0"]
    for order in (shuffled, lagging):
        state = empty
        for part in (order[:20], order[15:50], order[50:]):
            state = spark.createDataFrame(cdc.next_version(state, frame(part)).collect(), cdc.STATE)
        assert docs(state) == want
    settled, cut = empty, (15, 0)
    for part, point in (([r for r in unique if r[1] < cut], None), ([r for r in unique if r[1] >= cut], cut), (unique, cut)):
        settled = spark.createDataFrame(cdc.next_version(settled, frame(part), point).collect(), cdc.STATE)
    assert docs(settled) == want and all(x.t >= 15 for r in settled.collect() if r.rec_id in {u[4] for u in unique if u[1] >= cut} for x in r.log)
