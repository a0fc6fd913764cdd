"""Streams with state: late rows and reconciliation."""

import datetime as dt

from adlumen.operators.linking import payment_reconciliation
from adlumen.schemas import PAYMENT_SCHEMA
from adlumen.streaming.late import read_deduplicated, store_batch
from adlumen.streaming.reconcile import payment_reconciliation_stream
from adlumen.streaming.windows import dedup_stream
from rows import T0, bronze, collect

H = dt.timedelta(hours=1)


def at(hours, name, **change):
    return {"timestamp": T0 + hours * H, "impression_id": name, **change}


def test_late_rows_are_kept_once(spark, tmp_path):
    root = str(tmp_path / "kept")
    batches = [
        [at(0, "a"), at(10, "b"), at(10.1, "b")],
        [at(1, "late"), at(1.2, "late"), at(0.5, "a"), at(11, "c"), at(9.5, "b")],
        [at(1, "late"), at(2, "later"), at(30, "d"), at(11, "c")],
        [at(2, "later"), at(1, "late"), at(0, "a"), at(31, "e"), at(29.5, None)],
    ]
    for _ in range(2):  # the second time as if every batch had been repeated
        for number, rows in enumerate(batches):
            store_batch(bronze(spark, *rows), number, root, H)
    assert collect(read_deduplicated(spark, root), "impression_id") == [("a",), ("b",), ("c",), ("d",), ("e",), ("late",), ("later",), (None,)]
    assert collect(read_deduplicated(spark, root, late=True), "impression_id", "timestamp") == [("late", T0 + H), ("later", T0 + 2 * H)]
    store_batch(bronze(spark, at(0, "z")).limit(0), 4, root, H)
    assert read_deduplicated(spark, root).count() == 8


def test_a_batch_repeated_alone_decides_as_before(spark, tmp_path):
    root = str(tmp_path / "kept")
    for number, rows in [(0, [at(0, "a"), at(10, "b")]), (1, [at(1, "c"), at(0, "a")]), (1, [at(1, "c"), at(0, "a")]), (0, [at(0, "a"), at(10, "b")])]:
        store_batch(bronze(spark, *rows), number, root, H)
    assert collect(read_deduplicated(spark, root), "impression_id") == [("a",), ("b",), ("c",)]


def test_streams_of_payments_and_impressions_meet(spark, tmp_path):
    def streamed(name, frames):
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    def paid(*rows):
        return spark.createDataFrame([(p, "adv_001", c, 5.0, "USD", "x", "settled", T0 + h * H) for p, c, h in rows], PAYMENT_SCHEMA)

    end = T0 + 400 * H
    seen = [[at(0, "a"), at(3, "b")], [at(2.5, "late", bid_price=2.0), at(7, "c")], [at(6.5, "d", campaign_id="camp_002"), at(14, "e")], [at(15, "f")], [{"timestamp": end, "impression_id": "end"}]]
    payments = [paid(("p1", "camp_001", 6), ("p2", "camp_009", 6)), paid(("p3", "camp_001", 9)), paid(("p3", "camp_001", 9), ("p4", "camp_002", 13)), paid(("p5", None, 14)), paid(("end", "camp_001", 400))]
    stream = payment_reconciliation_stream(streamed("payments", payments), dedup_stream(streamed("impressions", [bronze(spark, *s) for s in seen])))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    assert len(query.recentProgress) >= 5
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    impressions = bronze(spark, *[r for s in seen[:-1] for r in s])
    every = paid(("p1", "camp_001", 6), ("p2", "camp_009", 6), ("p3", "camp_001", 9), ("p4", "camp_002", 13), ("p5", None, 14))
    assert collect(got.drop("timestamp")) == collect(payment_reconciliation(every, impressions).select(got.columns).drop("timestamp"))
    assert collect(got, "payment_id", "matched_impressions") == [("p1", 3), ("p2", 0), ("p3", 2), ("p4", 0), ("p5", 0)]


def test_a_payment_meets_only_what_is_near_it(spark, tmp_path):
    def streamed(name, *frames):
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    def paid(*rows):
        return spark.createDataFrame([(p, "adv_001", "camp_001", 5.0, "USD", "x", "settled", T0 + h * H) for p, h in rows], PAYMENT_SCHEMA)

    # One campaign over 900 hours; spans begin and end on impressions, on edges of six hours and between.
    impressions = bronze(spark, *[at(1.5 * k, f"i{k}", bid_price=1.0 + k % 7) for k in range(600)])
    payments = paid(*[(f"p{k}", 1.5 * k + (0, 0.4, -1.5)[k % 3]) for k in range(1, 600)])
    stream = payment_reconciliation_stream(
        streamed("payments", payments, paid(("end", 2000))),
        dedup_stream(streamed("impressions", impressions, bronze(spark, at(2000, "end")))))
    query = (stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint"))
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert collect(got) == collect(payment_reconciliation(payments, impressions).select(got.columns))
    # Rows read from the join's state: all with all would be 360,000.
    reads = sum(o.customMetrics["rocksdbGetCount"] for p in query.recentProgress for o in p.stateOperators if o.operatorName == "symmetricHashJoin")
    assert 0 < reads < 100_000
