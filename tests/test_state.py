"""Time to live in streams."""

import datetime as dt
import random

from pyspark.sql import functions as F

from harborline.streaming import state

SCHEMA = "n bigint, kind string, id bigint, at timestamp, note struct<a: string, b: array<double>>"


def kept(rows, hours=24):
    """By the definition, one key after the other."""
    first, out = {}, []
    for n, kind, i, at, _ in sorted((r for r in rows if r[3]), key=lambda r: (r[3], r[0])):
        if (kind, i) not in first or at - first[kind, i] >= dt.timedelta(hours=hours):
            first[kind, i] = at
            out.append(n)
    return sorted(out)


def test_keys_share_states_and_live_as_long_as_they_should(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2025, 1, 1)
    seconds = lambda batch: batch * 20 * 3600 + rng.choice([0, 4 * 3600, rng.randrange(20 * 3600)])
    moments = lambda batch: start + dt.timedelta(seconds=seconds(batch), microseconds=rng.choice([0, 1, 999_999]))
    sent, got, states = [], [], []
    for batch in range(4):
        rows = [(1000 * batch + 100 + n, rng.choice(["a", 'b"\n', None]), rng.choice([None, *range(60)]), moments(batch) if rng.random() > 0.02 else None, ("x" * (n % 3), [n / 7]) if n % 5 else None) for n in range(400)]
        sent += rows
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        live = state.timed_to_live(stream, ["kind", "id"], "at", buckets=8)
        assert live.dtypes == stream.dtypes
        q = live.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
        states += [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    out = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out")
    assert sorted(r.n for r in out.select("n").collect()) == kept(sent)
    assert 0 < max(states) <= 8  # not one per key
    assert out.exceptAll(spark.createDataFrame(sent, SCHEMA)).count() == 0


def test_states_end(spark, tmp_path):
    start = dt.datetime(2025, 1, 1)
    states = []
    for batch, at in enumerate([start, start + dt.timedelta(hours=25), start + dt.timedelta(hours=80)]):
        df = spark.range(50 if batch == 0 else 1).select("id", F.lit(at).alias("at"))
        df.write.mode("append").parquet(f"{tmp_path}/in")
        live = state.timed_to_live(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["id"], "at", buckets=4)
        q = live.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
        states.append([s.numRowsTotal for p in q.recentProgress for s in p.stateOperators][-1])
    assert states == [4, 1, 1]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 52


def test_fractions_as_keys(spark, tmp_path):
    df = spark.createDataFrame([(n, x, dt.datetime(2025, 1, 1, n)) for n, x in enumerate([0.0, -0.0, float("nan"), float("nan"), None, None, 0.5])], "n bigint, x double, at timestamp")
    df.write.parquet(f"{tmp_path}/in")
    live = state.timed_to_live(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ["x"], "at", buckets=4)
    live.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 2, 4, 6]
