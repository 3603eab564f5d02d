"""Shapes of physical plans that must hold at scale."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest
from test_archive import plan_of

from seriesmill.operators import layout, reports
from seriesmill.operators.fold import fold
from seriesmill.operators.kernels import ValueEma
from seriesmill.plans import driver_tables, ordered_queries, report_queries

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = "/root/testdata/sf0.001"


def test_bins_shuffle_once_and_hash(spark):
    plan = plan_of(ordered_queries.time_weighted_bins(spark, SF_DIR))
    assert len(re.findall(r"Exchange \(\d+\)", plan)) == 1
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,event_id" in plan or "props" not in plan


def test_fold_is_one_shuffle(spark):
    plan = plan_of(fold(driver_tables.events(spark, SF_DIR), ["series"], ValueEma()))
    assert len(re.findall(r"Exchange \(\d+\)", plan)) == 1 and "MapInArrow" in plan


def test_layout_is_one_shuffle(spark):
    plan = plan_of(layout.lay_out(driver_tables.events(spark, SF_DIR)))
    assert len(re.findall(r"Exchange \(\d+\)", plan)) == 1


def test_top_k_is_cut_before_the_shuffle(spark):
    rows = driver_tables.events(spark, SF_DIR).withColumn("ts_msp", driver_tables.F.col("ts_ns")).withColumn("ts_lsp", driver_tables.F.col("ts_ns"))
    assert "WindowGroupLimit" in plan_of(reports.most_active(reports.activity(rows)))


@pytest.mark.parametrize("name", ["counter_sums", "liveness", "state_counts"])
def test_aggregations_combine_before_the_shuffle(spark, name):
    plan = plan_of(getattr(report_queries, name)(spark, SF_DIR))
    assert "partial_" in plan


def test_headers_are_parsed_once(spark):
    plan = plan_of(report_queries.message_headers(spark, SF_DIR))
    assert plan.count("from_json(") <= 4


def test_tasks_need_no_installed_package(tmp_path):
    """Executors have only PySpark: a session started elsewhere must run folds and decoders."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from seriesmill.session import build_session
from seriesmill.plans import ordered_queries, report_queries
spark = build_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
assert ordered_queries.partition_roll(spark, {SF_DIR!r}).count() > 0
assert report_queries.typed_values(spark, {SF_DIR!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
