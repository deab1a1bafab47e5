"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import pytest

import __spark_entry__ as entry
from eventlens.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_no_pair_explosion_no_python(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "Exchange SinglePartition"):
        assert bad not in p, (name, bad)
    # forced broadcasts are the ordered scan's tables of hot keys and cuts,
    # each limited to a fixed number of rows; anything else is left to
    # Spark's own size checks (static estimate or AQE)
    df = catalog.QUERIES[name](spark, SF)
    tree = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    for i, line in enumerate(tree):
        if "strategy=broadcast" in line:
            depth = line.index("Join")
            assert any("GlobalLimit" in below for below in tree[i + 1:] if len(below) > depth), (name, line)


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(catalog.QUERIES["hot_keys_topn"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


@pytest.mark.parametrize("name", ["hot_keys_topn", "hot_paths_topn", "click_cap_passed", "click_cap_warnings"])
def test_group_limit_before_shuffle(spark, name):
    p = plan(catalog.QUERIES[name](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_panes_aggregate_before_expanding(spark):
    p = plan(catalog.QUERIES["region_counts_sliding"](spark, SF))
    assert "Expand" not in p                       # no per-row 60-way expansion
    gen = p.index("Generate explode")
    assert "partial_count" in p[gen:]              # pane partial aggregate below the explode


@pytest.mark.parametrize("name", ["consecutive_errors", "pay_match_outcomes", "followed_within"])
def test_ordered_scan_shuffles_the_data_once(spark, name):
    """Without hot keys the plan is the plain window: one scan, one shuffle."""
    p = plan(catalog.QUERIES[name](spark, SF), final=True).split("== Initial Plan ==")[0]
    rows = [line for line in p.splitlines() if "Exchange" in line and "hashpartitioning" in line]
    assert len(rows) == 1 and "_kc0" in rows[0] and p.count("FileScan parquet") == 1, p
    assert "Join" not in p and "SortAggregate" not in p


def test_pattern_filters_reach_the_scan(spark):
    p = plan(catalog.QUERIES["followed_within"](spark, SF))
    assert "Or(EqualTo(event_type,signup),EqualTo(event_type,purchase))" in p


def test_reconcile_is_one_join(spark):
    p = plan(catalog.QUERIES["reconcile"](spark, SF))
    assert p.count("FullOuter") == 1 and "Window" not in p


@pytest.mark.parametrize("cap", [3, 5000])
def test_cap_ranks_in_time_buckets_first(spark, cap):
    from eventlens.operators.limits import click_cap
    p = plan(click_cap(catalog.events(spark, SF), ["user_id"], cap=cap, reset=None)[0])
    keys = [line for line in p.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keys) == 2 and "_b#" in keys[1] and "_b#" not in keys[0]


def test_interval_join_keys_include_time_bucket(spark):
    p = plan(catalog.QUERIES["interval_join"](spark, SF))
    assert "_jb" in p.split("Join")[1] if "Join" in p else False


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "user_id", "cnt", "rank"]
    assert df.count() > 0


def test_scale_conf_sizes_partitions():
    from eventlens.session import scale_conf
    c = scale_conf(100 * (1 << 40), executors=1000, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 32000         # 8 waves of 4000 slots, not 100 TiB / 256 MiB
    assert int(scale_conf(1 << 30, 10, 4)["spark.sql.shuffle.partitions"]) == 80   # at least 2x slots
