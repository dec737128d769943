"""A hot key holding a third of all rows: results stay exact, and no
(group, block) unit of work exceeds the block span."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from windlass.functions.columns import MICROS, epoch_micros
from windlass.operators import lateness, scan, windows
from windlass.sources.records import records_from_events, events

SPAN = 64


@pytest.fixture(scope="module")
def hot(spark):
    ev = events(spark, SF01)
    # a third of all events belong to user 0 -> one hot key (and a hot partition)
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    return records_from_events(skewed, stream_time=True, span=SPAN).cache()


def test_hot_key_share(hot):
    total = hot.count()
    top = hot.groupBy("key").count().orderBy(F.desc("count")).first()["count"]
    assert top >= total // 3


def test_update_stream_exact_under_skew(spark, hot):
    got = lateness.update_stream(hot, span=SPAN)
    kept = lateness.strict_kept(hot, span=SPAN)
    w = Window.partitionBy("key", "window_start").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    plain = kept.select("partition", "offset", F.sum("value").over(w).alias("agg"))
    diff = got.select("partition", "offset", "agg").exceptAll(plain)
    assert diff.count() == 0 and got.count() == plain.count()
    # the hot key's window groups are split into blocks of at most SPAN rows
    blocks = kept.groupBy("key", "window_start", scan.block_of("offset", SPAN).alias("b")).count()
    assert blocks.agg(F.max("count")).first()[0] <= SPAN


def test_stream_time_blocks_bounded(spark, hot):
    blocks = hot.groupBy("topic", "partition", scan.block_of("offset", SPAN).alias("b")).count()
    assert blocks.agg(F.max("count")).first()[0] <= SPAN
    w = Window.partitionBy("topic", "partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    plain = hot.select("partition", "offset", F.max("ts").over(w).alias("st"))
    assert hot.select("partition", "offset", F.col("stream_time").alias("st")).exceptAll(plain).count() == 0


def test_sessions_exact_under_skew(spark, hot):
    got = windows.session_sum(hot, 1800, block_seconds=60)
    d = hot.withColumn("__t", epoch_micros("ts"))
    w = Window.partitionBy("key").orderBy("__t")
    flagged = d.withColumn("__new", F.when((F.col("__t") - F.lag("__t").over(w)) <= 1800 * MICROS, 0).otherwise(1))
    sid = flagged.withColumn("__sid", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    plain = sid.groupBy("key", "__sid").agg(F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
                                            F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("agg"))
    a = got.select("key", "session_start", "session_end", "n", "agg")
    b = plain.select("key", "session_start", "session_end", "n", "agg")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
