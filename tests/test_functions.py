import datetime as dt

from pyspark.sql import functions as F

from netsift.functions import (action_of, ip_to_int, is_high_port, is_night, is_private_ip, is_privileged_port,
                               is_well_known_port, protocol_name, syslog_timestamp)


def test_ip_to_int_and_private(spark):
    ips = ["10.0.0.1", "1.2.3", "a.b.c.d", None, "1.2.3.4.5", "172.15.255.255", "172.16.0.0", "172.31.255.255",
           "172.32.0.0", "192.168.255.255", "10.300.0.1"]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    r = df.select(ip_to_int("ip").alias("n"), is_private_ip("ip").alias("p")).collect()
    assert [x.n for x in r[:5]] == [167772161, 0, 0, 0, 16909060]
    assert [x.p for x in r] == [1, 0, 0, 0, 0, 0, 1, 1, 0, 1, 0]


def test_syslog_time(spark):
    df = spark.createDataFrame([("Mar  2 18:00:25",), ("Feb 29 00:00:01",), ("garbage",)], "t string")
    r24 = [x[0] for x in df.select(syslog_timestamp("t", 2024)).collect()]
    r25 = [x[0] for x in df.select(syslog_timestamp("t", 2025)).collect()]
    assert r24[0] == dt.datetime(2024, 3, 2, 18, 0, 25)
    assert r24[1] == dt.datetime(2024, 2, 29, 0, 0, 1) and r25[1] is None
    assert r24[2] is None


def test_ports_protocol_action(spark):
    df = spark.createDataFrame([(1024, "6", "rt_flow_session_close", 22), (443, "99", "OTHER", 6),
                                (None, "1", "RT_FLOW_SESSION_DENY", None)], "p int, n string, e string, h int")
    r = df.select(is_well_known_port("p"), is_high_port("p"), is_privileged_port("p"), protocol_name("n"),
                  action_of("e"), is_night("h")).collect()
    assert tuple(r[0]) == (0, 0, 0, "TCP", "close", 1)
    assert tuple(r[1]) == (1, 0, 1, "99", "unknown", 1)
    assert tuple(r[2]) == (0, 0, 0, "ICMP", "deny", 0)


def test_syslog_time_by_places_and_by_formatter(spark):
    """The plain form is cut at fixed places, all others go through the formatter: the same times."""
    from netsift.functions.timefn import SYSLOG_FORMAT, syslog_timestamp
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    texts = [f"{m} {d:>2} {h:02}:{h * 2:02}:59" for m in months for d in range(0, 33) for h in (0, 9, 23, 24)]
    texts += ["jan  2 03:04:05", " Jan  2 03:04:05 ", "Jan 2 03:04:05", "Jan\t 2 03:04:05", "Jan 02 03:04:05", "Jan  2 03:04:60", "Foo  1 00:00:00",
              "Jan  2 3:04:05", "Jan  2 03:04:05\n", "Jan  2 03:04:05.5", "2024-01-02 03:04:05", "", "N/A", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for year in (2024, 2025):
        norm = F.concat(F.regexp_replace(F.trim("t"), r"\s+", " "), F.lit(f" {year}"))
        slow = F.try_to_timestamp(norm, F.lit(SYSLOG_FORMAT)).cast("timestamp_ntz")
        got = df.select("i", "t", syslog_timestamp("t", year).alias("a"), slow.alias("b"))
        assert got.where("NOT a <=> b").collect() == [] and got.where("a IS NOT NULL").count() > 12 * 28 * 3


def test_events_in_few_splits_are_dealt_to_all_cores(spark):
    from conftest import SF_SMALL
    from netsift.plans import catalog as C
    cores = spark.sparkContext.defaultParallelism
    lines = C.log_lines(spark, SF_SMALL)
    assert C.flows_df(spark, SF_SMALL).rdd.getNumPartitions() < cores <= lines.rdd.getNumPartitions()
