from netsift.operators.sessions import drop_zero_duration, pair_sessions, pairing_report

COLS = "timestamp string, event_type string, session_id string, src_ip string, dst_port int, protocol string, ord int"
C, K = "RT_FLOW_SESSION_CREATE", "RT_FLOW_SESSION_CLOSE"


def _ev(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_first_create_negative_and_median(spark):
    rows = [
        ("Jan  1 10:00:00", C, "1", "10.0.0.1", 80, "TCP", 1),
        ("Jan  1 10:00:05", C, "1", "10.0.0.1", 80, "TCP", 2),    # reuse: the first CREATE wins
        ("Jan  1 10:00:20", K, "1", "10.0.0.1", 80, "TCP", 3),    # 20 s
        ("Jan  1 10:00:30", K, "2", "10.0.0.1", 80, "TCP", 4),    # CREATE logged after its CLOSE
        ("Jan  1 10:00:40", C, "2", "10.0.0.1", 80, "TCP", 5),    # -10 s + 86400
        ("Jan  1 10:01:00", K, "3", "10.0.0.1", 80, "TCP", 6),    # no CREATE: median
        ("Jan  1 10:02:00", K, "4", "10.0.0.1", 80, "TCP", 7),
        ("Jan  1 10:02:00", C, "4", "10.0.0.1", 80, "TCP", 8),    # zero duration
    ]
    s = {r.session_id: r.duration for r in pair_sessions(_ev(spark, rows), 2024).collect()}
    assert s["1"] == 20.0 and s["2"] == 86390.0 and s["4"] == 0.0
    assert s["3"] == 20.0  # median of 20, 86390, 0
    assert sorted(r.session_id for r in drop_zero_duration(pair_sessions(_ev(spark, rows), 2024)).collect()) == \
        ["1", "2", "3"]
    rep = pairing_report(_ev(spark, rows), 2024).first()
    assert (rep.n_close, rep.n_paired, rep.n_negative_fixed, rep.n_median_filled) == (4, 3, 1, 1)


def test_year_end_stays_negative_and_no_pairs(spark):
    rows = [("Dec 31 23:59:59", C, "9", "10.0.0.1", 80, "TCP", 1), ("Jan  1 00:00:05", K, "9", "10.0.0.1", 80, "TCP", 2)]
    d = pair_sessions(_ev(spark, rows), 2024).first().duration
    assert d < 0  # one-year jump back, +86400 once is not enough (documented)
    only_closes = [("Jan  1 00:00:05", K, "7", "10.0.0.1", 80, "TCP", 1)]
    s = pair_sessions(_ev(spark, only_closes), 2024)
    assert s.first().duration is None
    assert drop_zero_duration(s).count() == 1  # NULL is kept by the null-safe filter


def test_feb29_non_leap(spark):
    rows = [("Feb 29 10:00:00", C, "5", "10.0.0.1", 80, "TCP", 1), ("Feb 29 10:00:09", K, "5", "10.0.0.1", 80, "TCP", 2)]
    assert pair_sessions(_ev(spark, rows), 2024).first().duration == 9.0
    assert pair_sessions(_ev(spark, rows), 2025).first().duration is None
