"""Streaming counts over CSV files that arrive in a folder."""

import os

from pyspark.sql import types as T

from larch.streaming import value_counts_stream

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "Nom_parc", "x")])


def write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        f.write("id,Nom_parc,x\n")
        for r in rows:
            f.write(r + "\n")


def test_counts_update_with_new_files(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "in")
    os.makedirs(folder)
    write(folder, "a.csv", ["1,Alpha,x", "2,,x", "3,Beta,x", "4,Alpha,x", "5,short"])
    query = (value_counts_stream(spark, folder, SCHEMA, "Nom_parc").writeStream
             .outputMode("complete").format("memory").queryName("park_counts")
             .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start())
    try:
        query.processAllAvailable()
        got = {r.Nom_parc: r.n for r in spark.sql("SELECT * FROM park_counts").collect()}
        assert got == {"Alpha": 2, "Beta": 1}
        write(folder, "b.csv", ["6,Beta,x", "7,Gamma,x", '8,"",x'])
        query.processAllAvailable()
        got = {r.Nom_parc: r.n for r in spark.sql("SELECT * FROM park_counts").collect()}
        assert got == {"Alpha": 2, "Beta": 2, "Gamma": 1}
    finally:
        query.stop()


def test_sessions_with_late_events_equal_the_batch(spark, tmp_dir):
    """Events come in shuffled batches, late within the watermark; sessions closed by it
    equal those of the whole table, and a later event is dropped."""
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from larch.operators import ordered
    from larch.streaming import session_stream

    rng, start = random.Random(5), dt.datetime(2024, 1, 1)
    times = sorted(rng.randint(0, 3000) for _ in range(150))
    events = [(rng.choice([7, 7, 1]), start + dt.timedelta(seconds=t), i) for i, t in enumerate(times)]
    late = events[:]
    for i in range(0, len(late) - 5, 5):
        part = late[i:i + 5]
        rng.shuffle(part)
        late[i:i + 5] = part
    schema, source = "k int, ts timestamp, id int", os.path.join(tmp_dir, "in")
    out = os.path.join(tmp_dir, "out")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source + "/*")
        told = session_stream(stream, "k", "ts", 30, "1000 seconds", [F.count(F.lit(1)).alias("n"), F.min("id").alias("id")])
        query = (told.writeStream.outputMode("append").format("parquet").option("path", out)
                 .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).trigger(availableNow=True).start())
        query.awaitTermination()

    for b in range(3):
        spark.createDataFrame(late[b * 50:(b + 1) * 50], schema).coalesce(1).write.parquet(f"{source}/{b}")
    run()
    # Far ahead: closes every session; the last event is far too late.
    spark.createDataFrame([(9, start + dt.timedelta(days=1), 900)], schema).coalesce(1).write.parquet(f"{source}/3")
    run()
    spark.createDataFrame([(7, start, 901)], schema).coalesce(1).write.parquet(f"{source}/4")
    run()
    got = {(r.k, r.id): (r.first, r.last, r.n) for r in spark.read.parquet(out).select("k", "id", "first", "last", "n").collect()
           if r.k != 9}
    laid = ordered.layout(spark.createDataFrame(events, schema), ["k"], ["ts", "id"], 20)
    want = ordered.sessions(laid, ["k"], "ts", 30).groupBy("k", "session").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    assert got == {(r.k, r.id): (r["first"], r["last"], r.n) for r in want.collect()}
    assert len(got) > 20
