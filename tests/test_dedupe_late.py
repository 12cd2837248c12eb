import datetime as dt

from pyspark.sql import functions as F

from harborline.operators import dedupe, late
from harborline.plans import pipeline_queries
from harborline.session import scratch_path

SCHEMA = "message_id bigint, event_type string, event_id string, ingest_time timestamp, facility_id string, event_time timestamp, _key string, kept int"
U = "0f0e0d0c-0b0a-4908-8706-050403020100"


def at(s):
    return dt.datetime(2025, 1, 1) + dt.timedelta(seconds=s)


def rows(spark, data):
    return spark.createDataFrame([(m, t, e, at(i) if i is not None else None, "F", at(0), "own", 1) for m, t, e, i in data], SCHEMA)


def ids(df):
    return sorted((r[0] is not None, r[0]) for r in df.select("message_id").collect())


def found(spark, df):
    k = dedupe.keyed(df)
    return sorted(r[0] for r in dedupe.copies(k, dedupe.first_arrivals(k)).collect())


def test_spellings_and_types(spark):
    df = rows(spark, [(1, "a.b", U, 5), (2, "a.b", " {" + U.upper() + "}", 3), (3, "a.b", U.replace("-", ""), 4), (4, "a.c", U, 1), (5, "a.b", "urn:uuid:" + U, 9)])
    assert found(spark, df) == [1, 3, 5]


def test_ties_nulls_and_repeats(spark):
    df = rows(spark, [(2, "a", "x", 1), (1, "a", "X ", 1), (3, "a", "x", None), (4, "a", None, 1), (5, "a", None, 1), (7, "b", "y", 2), (7, "b", "y", 2), (None, "b", "y", 2)])
    k = dedupe.keyed(df)
    out = [r[0] for r in dedupe.copies(k, dedupe.first_arrivals(k)).collect()]
    assert sorted(x for x in out if x is not None) == [2, 3, 7] and out.count(None) == 1
    kept = dedupe.keep_first(df)
    assert kept.columns == df.columns and kept.where("_key <> 'own'").count() == 0
    assert sorted(r[0] for r in kept.select("message_id").collect()) == [1, 4, 5, 7]


def test_empty(spark):
    df = rows(spark, [])
    assert found(spark, df) == [] and dedupe.keep_first(df).count() == 0


def test_store_over_batches(spark):
    store = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=3)
    first = rows(spark, [(n, "t", f"e{n % 50}", n) for n in range(200)])
    assert dedupe.keep_first(first, store).count() == 50
    again = rows(spark, [(n, "t", f"e{n % 80}", n) for n in range(300, 500)])
    first_of = {n % 80: n for n in range(499, 299, -1)}
    assert ids(dedupe.keep_first(again, store)) == sorted((True, n) for key, n in first_of.items() if key >= 50)
    assert dedupe.keep_first(again, store).count() == 0
    bits = store.bitmaps().select(F.sum(F.bitmap_count("bits"))).first()[0]
    assert bits == store.dictionary().count() == store.winners().count() == 80
    assert store.dictionary().select("segment", "shard", "ordinal").distinct().count() == 80
    assert len(store.manifest()["batches"]) == 3


def test_batches_read_touched_shards(spark, monkeypatch):
    store = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=8)
    store.deliver(dedupe.keyed(rows(spark, [(n, "t", f"e{n}", n) for n in range(400)])))
    few = dedupe.keyed(rows(spark, [(900, "t", "e7", 900), (901, "t", "new", 901)]))
    read = store.dictionary(few)
    files = {f.split("shard=")[1].split("/")[0] for f in read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert 0 < len(files) <= 2
    assert [r._key for r in store.deliver(few).collect()] == ["t:new"]
    monkeypatch.setattr(dedupe, "TOUCHED", 0)
    assert store.deliver(few).count() == 0


def test_bitmaps_are_put_together(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "COMPACTED", 2)
    store = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=2)
    got = [store.deliver(dedupe.keyed(rows(spark, [(n, "t", f"e{m}", n) for n, m in enumerate(range(k, k + 40))]))).count() for k in (0, 20, 40, 30, 100)]
    assert got == [40, 20, 20, 0, 40] and len(store.manifest()["bitmaps"]) < 4
    assert store.bitmaps().select(F.sum(F.bitmap_count("bits"))).first()[0] == 120


def test_bits_decide(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    right = sorted(r[0] for r in pipeline_queries.p7_found(spark, sf).collect())
    united = dedupe._united
    monkeypatch.setattr(dedupe, "_united", lambda b: united(b).where("false"))
    assert sorted(r[0] for r in pipeline_queries.p7_found(spark, sf).collect()) != right


def test_table_in_batches_by_arrival(spark, monkeypatch):
    df = dedupe.keyed(rows(spark, [(n, "t", f"e{n % 70}", (n * 37) % 200 // 2 if n % 9 else None) for n in range(200)]))
    store = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=3)
    got = store.deliver_in_order(df, "ingest_time").select("_key", "_ord")
    assert sorted(got.collect()) == sorted(dedupe.first_arrivals(df).collect()) and got.count() == 70
    assert len(store.manifest()["batches"]) == dedupe.BATCHES
    empty = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=3)
    assert empty.deliver_in_order(df.limit(0), "ingest_time").count() == 0
    # p7_found reads the bitmaps of earlier batches
    read = []
    probed = dedupe.SeenStore.bitmaps
    monkeypatch.setattr(dedupe.SeenStore, "bitmaps", lambda self: read.append(len(self.manifest()["bitmaps"])) or probed(self))
    pipeline_queries.p7_found(spark, "/root/testdata/sf0.001").count()
    assert read == list(range(1, dedupe.BATCHES))


def test_failed_batch_leaves_no_trace(spark):
    store = dedupe.SeenStore(spark, scratch_path(spark, "store"), shards=2)
    df = rows(spark, [(1, "t", "a", 1)])
    publish, store._publish = store._publish, lambda m: (_ for _ in ()).throw(RuntimeError)
    try:
        store.deliver(dedupe.keyed(df))
    except RuntimeError:
        pass
    store._publish = publish
    assert dedupe.keep_first(df, store).count() == 1


def test_late_classes_and_revisions(spark):
    # period [0, 300): on time before 300, late before 300 + 86400
    arrivals = [(1, 10), (2, 299), (3, 300), (4, 86_699), (5, 86_700), (6, None)]
    df = spark.createDataFrame([(m, "t", f"e{m}", at(i) if i is not None else None, None, at(0)) for m, i in arrivals] + [(7, "t", "e7", at(5), "F", None)], "message_id bigint, event_type string, event_id string, ingest_time timestamp, facility_id string, event_time timestamp")
    kept = late.kept_events(df)
    assert sorted(map(tuple, late.late_rows(kept).collect())) == [(3, "late"), (4, "late"), (5, "too_late")]
    revisions = late.revisions(kept).orderBy("revision").collect()
    assert [(r.revision, r.added, r.total) for r in revisions] == [(1, 2, 2), (2, 1, 3), (3, 1, 4)]
    assert late.beyond_cutoff(kept).first().too_late == 1
    assert late.late_rows(kept.limit(0)).count() == 0
    assert late.revisions(kept.limit(0)).count() == 0


def test_late_knows_every_spelling(spark):
    ids = [U, " {" + U.upper() + "}\t", U.replace("-", ""), "urn:uuid:" + U, "feed fff", "FEED FFF ", "eed"]
    df = spark.createDataFrame([(n, "a.b", e, at(n + 1), "F", at(0)) for n, e in enumerate(ids)], "message_id bigint, event_type string, event_id string, ingest_time timestamp, facility_id string, event_time timestamp")
    kept = sorted(r.message_id for r in late.kept_events(df).collect())
    assert kept == [0, 4, 6] == sorted(r.message_id for r in dedupe.keep_first(df).collect())


def test_the_triangle_decides(spark, monkeypatch):
    df = spark.createDataFrame([(m, "t", f"e{m}", at(i), None, at(0)) for m, i in [(1, 10), (3, 300), (5, 86_700)]], "message_id bigint, event_type string, event_id string, ingest_time timestamp, facility_id string, event_time timestamp")
    kept = late.kept_events(df)
    whole = late.revisions
    monkeypatch.setattr(late, "revisions", lambda *a: whole(*a).where("revision < 2"))
    assert sorted(map(tuple, late.late_rows(kept).collect())) == [(3, "too_late"), (5, "too_late")]
