import os

from pyspark.sql import functions as F

from netsift.functions.timefn import syslog_timestamp
from netsift.plans import catalog as C
from netsift.streaming import closed_stream, counts_stream, pair_stream, parse_stream, score_batches, start_memory_query

SF = "/root/testdata/sf0.001"


def test_stream_pairing_equals_batch(spark, scratch):
    C.log_lines(spark, SF).orderBy("ord").select("value").coalesce(1).write.text(os.path.join(scratch, "log"))
    ev = parse_stream(spark, os.path.join(scratch, "log"))
    s = pair_stream(ev, C.FIXTURE_YEAR, watermark="1 hour", max_session="10 minutes")
    q = start_memory_query(s, "pairs_t", checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from pairs_t")
    batch = C.sessions_df(spark, SF, drop_zero=False)
    assert got.count() == batch.count()
    paired = got.where("duration is not null")
    bad = paired.join(batch.select("session_id", F.col("duration").alias("bd")), "session_id") \
        .where("duration <> bd").count()
    assert bad == 0 and paired.count() > 0.8 * batch.count()


def test_stream_hour_counts_equal_batch(spark, scratch):
    C.log_lines(spark, SF).orderBy("ord").select("value").coalesce(1).write.text(os.path.join(scratch, "log"))
    closed = closed_stream(parse_stream(spark, os.path.join(scratch, "log")), C.FIXTURE_YEAR, watermark="1 hour")
    q = start_memory_query(counts_stream(closed, window="1 hour"), "cnt_t", mode="complete")
    q.processAllAvailable()
    q.stop()
    got = {r.window_start: (r.sessions, r.bytes_sent) for r in spark.sql("select * from cnt_t").collect()}
    batch = C.sessions_df(spark, SF, drop_zero=False).withColumn(
        "t", F.date_trunc("hour", syslog_timestamp("timestamp", C.FIXTURE_YEAR)))
    want = {r.t: (r.n, r.b) for r in batch.groupBy("t").agg(F.count("*").alias("n"), F.sum("bytes_sent").alias("b")).collect()}
    assert got == want


def test_stream_port_scan_matches_batch_on_closed_windows(spark, scratch):
    from netsift.operators.threats import port_scan
    from netsift.streaming import port_scan_stream
    C.log_lines(spark, SF).orderBy("ord").select("value").coalesce(1).write.text(os.path.join(scratch, "log"))
    s = closed_stream(parse_stream(spark, os.path.join(scratch, "log")), C.FIXTURE_YEAR, watermark="1 hour")
    q = start_memory_query(port_scan_stream(s, window="1 day", slide="12 hours", min_ports=2), "scan_t",
                           checkpoint=os.path.join(scratch, "ck3"))
    q.processAllAvailable()
    q.stop()
    got = {(r.window_start, r.src_ip): r.distinct_ports for r in spark.sql("select * from scan_t").collect()}
    want = {(r.window_start, r.src_ip): r.distinct_ports for r in port_scan(
        C.sessions_df(spark, SF, drop_zero=False).withColumn("ts", syslog_timestamp("timestamp", C.FIXTURE_YEAR)),
        "1 day", "12 hours", 2, ts="ts", approx=True).collect()}
    # append mode emits only windows closed by the watermark; those must agree with batch
    assert got and all(want.get(k) == v for k, v in got.items())


def _line(t, kind, sid):
    at = "192.0.2.1/1000->198.51.100.2/443"
    return (f"Jan 12 {t} FW1 RT_FLOW: RT_FLOW_SESSION_{kind}: session x {at} 0x0 junos-https {at} 0x0 N/A N/A N/A N/A 6 a b c "
            f"{sid} 1(2) 3(4)")


def test_stream_takes_the_first_create_and_waits_for_it(spark, scratch):
    path = os.path.join(scratch, "in")
    os.makedirs(path)
    batches = [[_line("10:00:00", "CREATE", 1), _line("10:00:04", "CREATE", 1), _line("10:00:08", "CLOSE", 1),
                _line("10:00:09", "CLOSE", 2), _line("10:00:01", "CLOSE", 3)],
               [_line("10:00:07", "CREATE", 1), _line("10:00:20", "CLOSE", 1), _line("10:00:05", "CREATE", 2)],
               [_line("23:00:00", "CREATE", 9)], [_line("23:00:01", "CREATE", 10)]]
    s = pair_stream(parse_stream(spark, path), C.FIXTURE_YEAR, watermark="10 minutes", max_session="1 hour", default_duration=7.0)
    q = start_memory_query(s, "first_t", checkpoint=os.path.join(scratch, "ck"))
    for i, lines in enumerate(batches):
        with open(os.path.join(path, f"{i}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        q.processAllAvailable()
    q.stop()
    got = sorted((r.session_id, r.duration) for r in spark.sql("select * from first_t").collect())
    assert got == [("1", 8.0), ("1", 20.0), ("2", 4.0), ("3", 7.0)]


def test_stream_negative_duration_gets_one_day(spark, scratch):
    path = os.path.join(scratch, "in")
    os.makedirs(path)
    with open(os.path.join(path, "a.txt"), "w") as f:
        f.write("\n".join([_line("10:00:30", "CREATE", 1), _line("10:00:10", "CLOSE", 1)]) + "\n")
    q = start_memory_query(pair_stream(parse_stream(spark, path), C.FIXTURE_YEAR), "neg_t", checkpoint=os.path.join(scratch, "ck"))
    q.processAllAvailable()
    q.stop()
    assert [r.duration for r in spark.sql("select * from neg_t").collect()] == [86380.0]


def test_replayed_batch_writes_its_alerts_once(spark, scratch):
    class Model:
        def transform(self, df):
            return df.withColumn("is_anomaly", F.lit(1))
    handle = score_batches(lambda b: b, Model(), os.path.join(scratch, "alerts"))
    for batch_id in (0, 1, 0):
        handle(spark.range(5), batch_id)
    assert spark.read.parquet(os.path.join(scratch, "alerts")).count() == 10


def test_stream_pairing_stays_in_the_jvm(spark, scratch):
    os.makedirs(os.path.join(scratch, "in"))
    s = pair_stream(parse_stream(spark, os.path.join(scratch, "in")), C.FIXTURE_YEAR)
    plan = s._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Join LeftOuter" in plan and "DeduplicateWithinWatermark" in plan


def test_late_and_repeated_events_are_dropped_and_counted(spark, scratch):
    from netsift.streaming import closed_windows_stream, run_available
    path, seen = os.path.join(scratch, "in"), []
    os.makedirs(path)
    batches = [[_line("10:00:00", "CLOSE", 1), _line("10:30:00", "CLOSE", 2), _line("12:00:00", "CLOSE", 3)],
               [_line("10:40:00", "CLOSE", 4), _line("11:40:00", "CLOSE", 5), _line("12:00:00", "CLOSE", 3), _line("15:00:00", "CLOSE", 6)]]
    dropped = []
    for i, lines in enumerate(batches):
        with open(os.path.join(path, f"{i}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        s = closed_windows_stream(closed_stream(parse_stream(spark, path), C.FIXTURE_YEAR, "30 minutes"))
        dropped.append(run_available(s, os.path.join(scratch, "ck"), lambda b, k: seen.extend((r.window_start.hour, r.sessions) for r in b.collect())))
    assert sorted(seen) == [(10, 2), (11, 1), (12, 1)]  # 4 came too late, 3 came twice, 6's window is open
    assert dropped == [{"late": 0, "repeated": 0}, {"late": 1, "repeated": 1}]
