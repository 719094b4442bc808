"""Property tests: random inputs against brute force (each example is one Spark job)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickstats.operators.ingest import ingest_access_log, ingest_behavior
from clickstats.operators.windows import interval_counts
from conftest import lines_df

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

intervals = st.lists(st.tuples(st.sampled_from("abc"), st.integers(-50, 300), st.integers(0, 40),
                               st.integers(1, 3)), min_size=0, max_size=60)


@SETTINGS
@given(rows=intervals, block_windows=st.sampled_from([1, 2, 16]))
def test_interval_counts_equal_brute_force(spark, rows, block_windows):
    data = [(k, f, f + span, w) for k, f, span, w in rows]
    df = spark.createDataFrame(data, "key string, f bigint, l bigint, w bigint")
    got = {(r.key, r.window_end, r["count"]) for r in
           interval_counts(df, ["key"], "f", "l", "w", 410, 10, block_windows=block_windows).collect()}
    want = {}
    for k, f, l, w in data:
        for i in range(f, l + 1):
            want[(k, i * 10 + 410)] = want.get((k, i * 10 + 410), 0) + w
    assert got == {(k, e, c) for (k, e), c in want.items()}


behavior = st.tuples(st.integers(-2**63, 2**63 - 1), st.integers(-2**63, 2**63 - 1),
                     st.integers(-2**31, 2**31 - 1),
                     st.text(st.characters(blacklist_characters=",\n\r", blacklist_categories=["Cs"]),
                             min_size=1, max_size=8),
                     st.integers(-2**40, 2**40))


@SETTINGS
@given(records=st.lists(behavior, min_size=1, max_size=50))
def test_behavior_render_parse_round_trip(spark, records):
    lines = [",".join(map(str, r)) for r in records]
    got = sorted(tuple(r) for r in ingest_behavior(lines_df(spark, lines)).rows
                 .select("user_id", "item_id", "category_id", "behavior", "ts_sec").collect())
    assert got == sorted(records)


@SETTINGS
@given(stamps=st.lists(st.integers(0, 4_102_444_799), min_size=1, max_size=50))
def test_log_time_round_trip(spark, stamps):
    import datetime as dt
    lines = [f"1.2.3.4 u - {dt.datetime.fromtimestamp(s, dt.UTC).strftime('%d/%m/%Y:%H:%M:%S')} +0000 GET /x"
             for s in stamps]
    got = sorted(r.event_ms for r in ingest_access_log(lines_df(spark, lines)).rows.collect())
    assert got == sorted(s * 1000 for s in stamps)


def test_salted_totals_equal_unsalted(spark):
    from conftest import SF_MID
    from clickstats.plans import jobs, registered
    rows = registered.behavior_rows(spark, SF_MID)
    plain = {(r.window_end, r["count"]) for r in jobs.page_views(rows).collect()}
    for salts in (1, 4, 16):
        salted = {(r.window_end, r["count"]) for r in jobs.page_views_salted(rows, salts=salts).collect()}
        assert salted == plain
    assert sum(c for _, c in plain) == rows.where(jobs.is_page_view()).count()


late_rows = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3000), st.integers(0, 6),
                               st.booleans()), min_size=1, max_size=60)


@SETTINGS
@given(data=late_rows, lateness_s=st.sampled_from([0, 30, 120]))
def test_split_late_and_accepted_counts_equal_brute_force(spark, data, lateness_s):
    from pyspark.sql import functions as F

    from clickstats.operators.late import accepted_counts, split_late
    size, slide, delay, lateness = 300_000, 60_000, 1_000, lateness_s * 1000
    rows = [(k, t * 1000, b, kept) for k, t, b, kept in data]
    df = spark.createDataFrame(rows, "key string, event_ms bigint, batch_id bigint, kept boolean")
    split = split_late(df, F.col("kept"), size, slide, delay, lateness)
    got_late = sorted((r.key, r.event_ms, r.batch_id) for r in split.late.collect())
    got_counts = {(r.key, r.window_end, r["count"]) for r in
                  accepted_counts(split.on_time, "key", size, slide, lateness).collect()}

    want_late, counts = [], {}
    for k, t, b, kept in rows:
        earlier = [tt for _, tt, bb, _ in rows if bb < b]          # every row moves event time, kept or not
        wm = max(earlier) - delay if earlier else None
        if not kept:
            continue
        ends = [(t // slide + j) * slide for j in range(1, size // slide + 1)]
        open_ends = [e for e in ends if wm is None or e - 1 + lateness > wm]
        if not open_ends:
            want_late.append((k, t, b))
        for e in open_ends:
            counts[(k, e)] = counts.get((k, e), 0) + 1
    assert got_late == sorted(want_late)
    assert got_counts == {(k, e, c) for (k, e), c in counts.items()}


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 4), st.integers(1, 4)), min_size=1, max_size=80,
                     unique_by=lambda x: (x[0], x[1])),
       n=st.integers(1, 6))
def test_top_n_equals_sorting(spark, data, n):
    from clickstats.operators.rank import top_n
    df = spark.createDataFrame(data, "item_id bigint, window_end bigint, count bigint")
    got = {(r.item_id, r.window_end, r["count"], r.rank) for r in top_n(df, "item_id", n).collect()}
    want = set()
    for w in {w for _, w, _ in data}:
        ranked = sorted((x for x in data if x[1] == w), key=lambda x: (-x[2], x[0]))[:n]
        want |= {(i, w, c, r) for r, (i, _, c) in enumerate(ranked, start=1)}
    assert got == want


def _java_ts(ms: int) -> str:
    import datetime as dt
    wall = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
    frac = "0" if ms % 1000 == 0 else f"{ms % 1000:03d}".rstrip("0")
    return wall.strftime("%Y-%m-%d %H:%M:%S") + "." + frac


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 99), st.integers(-10**12, 4 * 10**12), st.integers(1, 9)),
                     min_size=1, max_size=30, unique_by=lambda x: (x[0], x[1])))
def test_render_report_equals_formatting(spark, data):
    from clickstats.operators.rank import HOT_ITEMS_LAYOUT as L, render_report, top_n
    top = top_n(spark.createDataFrame(data, "item_id bigint, window_end bigint, count bigint"), "item_id", 5)
    got = {r.window_end: r.report for r in render_report(top, "item_id", L).collect()}
    want = {}
    for w in {w for _, w, _ in data}:
        ranked = sorted((x for x in data if x[1] == w), key=lambda x: (-x[2], x[0]))[:5]
        lines = "".join(f"{L.rank_label}{r}{L.key_label}{i}{L.count_label}{c}{L.row_end}"
                        for r, (i, _, c) in enumerate(ranked, start=1))
        want[w] = f"{L.head}{L.time_label}{_java_ts(w)}{L.after_time}{lines}{L.tail}"
    assert got == want
