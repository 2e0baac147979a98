"""What the physical plans must not and must contain."""

import re

import pytest

from framelake.plans import registry

SF = "/root/testdata/sf0.001"
STREAMS = [n for n in registry.QUERIES if n.startswith(("st1_", "st2_", "sk3_")) or n.endswith("_stream")]


def plan(spark, name):
    return registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in STREAMS])
def test_no_pair_joins_and_no_global_windows(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        # the first entry is a partition column, not an order
        assert not re.match(r"\S+ (ASC|DESC)", spec.strip()), spec


@pytest.mark.parametrize("name, columns", [
    ("w1_keyframes", {"event_id", "user_id", "props"}), ("a1_scene_statistic", {"event_id", "ts", "user_id", "props"}),
    ("a7_bucketed_count_day", {"o_orderdate", "o_orderstatus"}), ("p14_round_robin", {"page_id", "url"}),
    ("st6_counter_rate", {"event_id", "ts", "user_id", "event_type"}), ("s6_pending", {"page_id", "url"})])
def test_scans_read_only_what_is_used(spark, name, columns):
    read = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name)) for c in s.split(",")}
    assert read <= columns


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan(spark, "a7_bucketed_count_day")


@pytest.mark.parametrize("name", ["f3_diversity_select", "f3_diversity_by_location", "p25_annotation_labels"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", plan(spark, name))


def test_a_sample_of_sliding_rates_counts_once(spark):
    text = plan(spark, "st6_counter_rate_sliding")
    panes = text.index("partial_sum(increase")
    assert "Expand" not in text and text.count("partial_sum(increase") == 1
    assert text.index("Generate") < panes and "Generate" not in text[panes:]
