"""Queries run in scheduler pools of their own, so alerts do not wait behind windows."""

import subprocess
import sys
from pathlib import Path

import pytest
from test_streams import LATE_COUNTED, ONCE, Topic, readings, run

from waymeter.config import StreamConfig
from waymeter.session import POOL, STREAM_SETTINGS, scheduler_pool
from waymeter.streaming import queries as Q


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def test_each_query_has_its_pool(spark, topic, tmp_path):
    topic.add_readings(LATE_COUNTED)
    config, seen = StreamConfig(checkpoint_base=f"{tmp_path}/c"), {}

    def note(name):
        def sink(batch, batch_id):
            batch.write.format("noop").mode("overwrite").save()
            seen.setdefault(name, set()).add(batch.sparkSession.sparkContext.getLocalProperty(POOL))
        return sink

    run(Q.start_congestion_sink(readings(spark, topic), config, note("congestion"), ONCE))
    run(Q.start_alerts(readings(spark, topic), config, note("critical"), ONCE))
    run(Q.start_live_congestion(readings(spark, topic), config, note("live"), ONCE))
    assert seen == {"congestion": {"traffic-congestion"}, "critical": {"traffic-critical"}, "live": {"traffic-congestion-live"}}
    assert STREAM_SETTINGS["spark.scheduler.mode"] == "FAIR"


def test_the_caller_s_pool_comes_back(spark):
    context = spark.sparkContext
    with scheduler_pool(spark, "outer"):
        with pytest.raises(KeyError):
            with scheduler_pool(spark, "inner"):
                assert context.getLocalProperty(POOL) == "inner"
                raise KeyError
        assert context.getLocalProperty(POOL) == "outer"
    assert context.getLocalProperty(POOL) is None


def test_alerts_do_not_wait_for_a_long_window_batch(tmp_path):
    """Of six seconds' work on all cores, begun before: alerts wait for the rest of it in one pool, not in two."""
    script, waited = Path(__file__).with_name("fair_pools.py"), {}
    for mode in ("fair", "fifo"):
        (tmp_path / mode).mkdir()
        done = subprocess.run([sys.executable, str(script), str(tmp_path / mode), mode], capture_output=True, text=True, timeout=300)
        line = next((x for x in done.stdout.splitlines() if x.startswith("ORDER")), done.stderr[-2000:])
        first, second, waited[mode] = line.split()[1:4]
        if mode == "fair":
            assert (first, second) == ("critical", "congestion")
    assert 2 * float(waited["fair"]) < float(waited["fifo"])
