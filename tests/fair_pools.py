"""Run by test_pools: a long window batch holds the only cores, then alerts come. Prints who finished first."""

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]
from test_streams import ONCE, Topic, message, readings  # noqa: E402

from waymeter.config import StreamConfig  # noqa: E402
from waymeter.session import SETTINGS, STREAM_SETTINGS  # noqa: E402
from waymeter.streaming import queries as Q  # noqa: E402


def main(folder: str, mode: str) -> None:
    settings = {**SETTINGS, **(STREAM_SETTINGS if mode == "fair" else {}), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = (SparkSession.builder.master("local[2]").config(map=settings).config("spark.sql.shuffle.partitions", "2")
             .config("spark.checkpoint.dir", f"{folder}/shared").getOrCreate())
    topic = Topic(Path(folder) / "topic")
    topic.add(message("08:00:10", 10, 5.0), message("08:30:00", 10, 20.0))
    config, ends = StreamConfig(checkpoint_base=f"{folder}/checkpoints"), {}

    @F.udf(T.LongType())
    def slow(x):
        time.sleep(0.5)
        return x

    def long_batch(batch, batch_id):
        batch.write.format("noop").mode("overwrite").save()
        # Two dozen tasks of half a second on two cores.
        batch.sparkSession.range(0, 24, 1, 24).select(slow("id")).write.format("noop").mode("overwrite").save()
        ends["congestion"] = time.time()

    def alerts(batch, batch_id):
        batch.write.format("noop").mode("overwrite").save()
        ends["critical"] = time.time()

    windows = Q.start_congestion_sink(readings(spark, topic), config, long_batch, ONCE)
    while not any(spark.sparkContext.statusTracker().getStageInfo(s) and spark.sparkContext.statusTracker().getStageInfo(s).numTasks == 24
                  for s in spark.sparkContext.statusTracker().getActiveStageIds()):
        time.sleep(0.05)
    begun = time.time()
    critical = Q.start_alerts(readings(spark, topic), config, alerts, ONCE)
    critical.awaitTermination(120)
    waited = time.time() - begun
    windows.awaitTermination(120)
    print("ORDER", *sorted(ends, key=ends.get), round(waited, 1))
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
