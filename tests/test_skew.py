"""A card that holds a third of all taps: detected, chunked evenly, same result."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from tapflow.operators import clean, skew, trips
from tapflow.plans.queries import TapFlow

HOT_CARD = "HOT"


def skewed(df, time_col="trade_time", card=HOT_CARD):
    # every third tap is re-assigned to one card (and to one day)
    hot = (F.abs(F.hash(time_col)) % 3) == 0
    return (df.withColumn("card_id", F.when(hot, F.lit(card)).otherwise(F.col("card_id")))
              .withColumn("trade_date", F.when(hot, F.lit("20240101"))
                          .otherwise(F.col("trade_date"))))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_card_detected_and_chunks_balanced(spark):
    taps = skewed(TapFlow(spark, SF001).inputs["metro_taps"])
    total = taps.count()
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    assert hot is not None and hot.count == 1
    assert hot.rows > total // 4
    split = skew.split_hot(taps, hot)
    assert split.cold.count() + split.hot.count() == total
    target = 200
    chunks = skew.chunk_count(split.hot_rows, target)
    chunked = skew.assign_chunks(split.hot, ["trade_time"], chunks)
    sizes = [r["n"] for r in chunked.groupBy(skew.CHUNK).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1
    assert max(sizes) <= 3 * target  # no chunk holds the hot card whole


def test_metro_clean_skewed_matches_windows(spark):
    taps = skewed(TapFlow(spark, SF001).inputs["metro_taps"])
    plain = clean.clean_metro(taps)
    chunked = clean.clean_metro(taps, hot_threshold=500, rows_per_chunk=200)
    assert same(plain, chunked)


def test_od_skewed_matches_windows(spark):
    tf = TapFlow(spark, SF001, hot_threshold=None)
    taps = skewed(tf.all_taps, "mark_trade_time")
    plain = trips.od_records(taps)
    chunked = trips.od_records(taps, hot_threshold=500, rows_per_chunk=200)
    assert same(plain, chunked)


def test_null_card_takes_a_third(spark):
    taps = skewed(TapFlow(spark, SF001).inputs["metro_taps"], card=None)
    plain = clean.clean_metro(taps, hot_threshold=None)
    chunked = clean.clean_metro(taps, hot_threshold=500, rows_per_chunk=200)
    assert same(plain, chunked)
    ids = clean.number_trips(taps, hot_threshold=500, rows_per_chunk=200)
    assert same(clean.metro_trip_ids(taps), ids)


def test_fallbacks_without_broadcast(spark, monkeypatch):
    """Every table that is broadcast behind a count is joined by shuffle beyond it."""
    tf = TapFlow(spark, SF001, hot_threshold=None)
    metro, merged = skewed(tf.inputs["metro_taps"], card=None), skewed(tf.all_taps, "mark_trade_time")
    plain, od = clean.clean_metro(metro, hot_threshold=None), trips.od_records(merged, hot_threshold=None)
    monkeypatch.setattr(skew, "MAX_BROADCAST_ROWS", 0)
    assert same(plain, clean.clean_metro(metro, hot_threshold=500, rows_per_chunk=200))
    assert same(od, trips.od_records(merged, hot_threshold=500, rows_per_chunk=200))


def test_hot_keys_are_bounded(spark, monkeypatch):
    taps = skewed(TapFlow(spark, SF001).inputs["metro_taps"])
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 5)
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=0)
    assert 1 <= hot.count <= 5


def one_time(df, time_col, n=3):
    """A third of all taps on one card, on one day and in one second."""
    return (skewed(df, time_col).withColumn(time_col, F.when(
        F.col("card_id") == HOT_CARD, F.to_timestamp_ntz(F.lit("2024-01-01 08:30:00"))).otherwise(F.col(time_col))))


def chunk_sizes(taps, order, tie, rows_per_chunk=200):
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    split = skew.split_hot(taps, hot)
    chunked = skew.assign_chunks(split.hot, order, skew.chunk_count(split.hot_rows, rows_per_chunk), tie=tie)
    return [r["n"] for r in chunked.groupBy(skew.CHUNK).agg(F.count("*").alias("n")).collect()]


def test_one_time_is_cut_metro(spark):
    """Peers of one RANGE frame fill many chunks; numbers and kept taps are those of the windows."""
    taps = one_time(TapFlow(spark, SF001).inputs["metro_taps"], "trade_time")
    sizes = chunk_sizes(taps, ["trade_time"], clean.METRO_TIE)
    assert len(sizes) > 5 and max(sizes) <= 2 * 200
    ids = clean.number_trips(taps, hot_threshold=500, rows_per_chunk=200)
    assert same(clean.metro_trip_ids(taps), ids)
    assert same(clean.clean_metro(taps, hot_threshold=None), clean.clean_metro(taps, hot_threshold=500, rows_per_chunk=200))


def test_peers_begin_and_end_inside_chunks(spark):
    """Times before, between and after two hot seconds, one of them null, on one card."""
    n = F.col("id")
    time = (F.when(n < 150, F.timestamp_add("SECOND", n, F.to_timestamp_ntz(F.lit("2024-01-01 05:00:00"))))
            .when(n < 900, F.to_timestamp_ntz(F.lit("2024-01-01 08:00:00")))
            .when(n < 930, F.timestamp_add("SECOND", n, F.to_timestamp_ntz(F.lit("2024-01-01 09:00:00"))))
            .when(n < 1700, F.to_timestamp_ntz(F.lit("2024-01-01 11:00:00")))
            .when(n < 1900, F.lit(None)).otherwise(
                F.timestamp_add("SECOND", n, F.to_timestamp_ntz(F.lit("2024-01-01 12:00:00")))))
    io = F.when(n % 3 == 0, F.lit("I")).when(n % 3 == 1, F.lit("O"))
    taps = spark.range(0, 2_000, 1, 8).select(
        F.lit("C").alias("card_id"), F.lit("01").alias("card_type"), (n % 7).cast("string").alias("line_id"),
        F.concat(F.lit("S"), n % 61).alias("station_id"), F.lit("D1").alias("device_id"), time.alias("trade_time"),
        io.alias("io_type"), F.lit("20240101").alias("trade_date"))
    for size in (37, 100, 400):
        ids = clean.number_trips(taps, hot_threshold=0, rows_per_chunk=size)
        assert same(clean.metro_trip_ids(taps), ids)
        assert same(clean.clean_metro(taps, hot_threshold=None), clean.clean_metro(taps, hot_threshold=0, rows_per_chunk=size))


def test_copies_of_one_tap_are_cut(spark):
    """1,600 copies of one whole row, read by 16 tasks."""
    copies = spark.range(0, 1_600, 1, 16).select(
        F.lit("C").alias("card_id"), F.lit("01").alias("card_type"), F.lit("1").alias("line_id"), F.lit("S").alias("station_id"),
        F.lit("D1").alias("device_id"), F.to_timestamp_ntz(F.lit("2024-01-01 08:00:00")).alias("trade_time"),
        F.lit("I").alias("io_type"), F.lit("20240101").alias("trade_date"))
    sizes = chunk_sizes(copies, ["trade_time"], clean.METRO_TIE)
    assert max(sizes) <= 2 * 200
    assert same(clean.metro_trip_ids(copies), clean.number_trips(copies, hot_threshold=500, rows_per_chunk=200))


def test_one_second_is_cut_od(spark):
    """OD cut: one second and trip id hold a third of the taps; all steps equal the windows."""
    tf = TapFlow(spark, SF001, hot_threshold=None)
    # several trip ids, so that runs end inside and at the edge of the hot second
    taps = one_time(tf.all_taps, "mark_trade_time").withColumn("tms_id", F.when(
        F.col("card_id") == HOT_CARD, F.when(F.hash("station_id", "trade_time") % 5 == 0, F.lit("8")).otherwise(F.lit("9"))
    ).otherwise(F.col("tms_id"))).distinct()
    from tapflow.functions.columns import epoch_seconds
    base = taps.withColumn(trips.EPOCH, epoch_seconds(taps, "mark_trade_time"))
    sizes = chunk_sizes(base, ["tms_id", trips.EPOCH], trips.GAP_TIE)
    assert len(sizes) > 5 and max(sizes) <= 2 * 200
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    tagged = skew.split_hot(taps, hot).hot
    for step in ("gaps", "segments", "marks", "records"):
        got = trips.od_part(tagged.drop(skew.KID), step, hot, rows_per_chunk=200)
        want = trips.od_part(tagged.drop(skew.KID), step)
        assert same(want.select(*got.columns), got), step
    assert same(trips.od_records(taps, hot_threshold=None), trips.od_records(taps, hot_threshold=500, rows_per_chunk=200))


def test_small_chunks_share_tasks_od(spark):
    """Chunks far beyond the session's shuffle partitions: no task, file or range of their own."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taps = skewed(TapFlow(spark, SF001, hot_threshold=None).all_taps, "mark_trade_time")
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    tagged = skew.split_hot(taps, hot).hot.drop(skew.KID)
    chunked = trips.od_part(tagged, "records", hot, rows_per_chunk=10)
    assert hot.rows // 10 > 10 * parts
    assert chunked.rdd.getNumPartitions() <= parts
    assert same(trips.od_part(tagged), chunked)


def test_small_chunks_share_tasks_metro(spark):
    """The same of metro cleaning; a task's chunks follow each other and hold no more rows than asked for."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    taps = one_time(TapFlow(spark, SF001).inputs["metro_taps"], "trade_time")
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    split = skew.split_hot(taps, hot)
    cut = skew.cut(spark, split.hot_rows, 10)
    assert cut.chunks > 10 * parts and cut.tasks == parts
    chunked = skew.assign_chunks(split.hot, ["trade_time"], cut.chunks, clean.METRO_TIE, cut.tasks)
    assert chunked.rdd.getNumPartitions() == parts
    order = F.struct("trade_time", *clean.METRO_TIE)
    edges = chunked.groupBy(skew.CHUNK).agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high"))
    assert edges.agg(F.sum("n"), F.max("n")).first() == (split.hot_rows, 10)
    after = F.lead("low").over(Window.orderBy(skew.CHUNK))
    assert edges.withColumn("after", after).where(F.col("high") > F.col("after")).isEmpty()
    chunked = clean.number_trips(taps.join(F.broadcast(hot.ids), F.col("card_id") == F.col("_hk_card_id"), "left_semi"),
                                 None, 10, hot)
    assert chunked.rdd.getNumPartitions() <= 2 * parts  # those of the (empty) rest, and the chunks'
    assert same(clean.clean_metro(taps, hot_threshold=None), clean.clean_metro(taps, hot_threshold=500, rows_per_chunk=10))


def test_large_chunks_keep_their_tasks(spark):
    """Beyond a million rows a task, tasks grow with the rows, whatever the session's shuffle partitions."""
    rows = 40 * skew.ROWS_PER_CHUNK
    assert skew.cut(spark, rows) == skew.Cut(40, 40)
    assert skew.cut(spark, rows, 1_000) == skew.Cut(40_000, 40)
    assert skew.cut(spark, rows, 10 * skew.ROWS_PER_CHUNK) == skew.Cut(4, 4)


def test_shared_tasks_are_bounded(spark, monkeypatch):
    """A session of many shuffle partitions: tasks of small chunks, and the rows that the range partitioner
    takes to the driver for each, do not grow with the rows until a task would get over a million."""
    many = spark.newSession()
    many.conf.set("spark.sql.shuffle.partitions", "100000")
    for rows in (6_600_000, 39_600_000):
        assert skew.cut(many, rows, 1_000) == skew.Cut(rows // 1_000, skew.MAX_SHARED_TASKS)
    assert skew.cut(many, 2_000 * skew.ROWS_PER_CHUNK, 1_000).tasks == 2_000
    monkeypatch.setattr(skew, "MAX_SHARED_TASKS", 3)
    taps = one_time(TapFlow(spark, SF001).inputs["metro_taps"], "trade_time")
    hot = skew.find_hot_keys(taps, ["trade_date", "card_id"], threshold=500)
    split = skew.split_hot(taps, hot)
    cut = skew.cut(spark, split.hot_rows, 10)
    assert cut.tasks == 3
    chunked = skew.assign_chunks(split.hot, ["trade_time"], cut.chunks, clean.METRO_TIE, cut.tasks)
    assert chunked.rdd.getNumPartitions() == 3
    assert chunked.groupBy(skew.KID).count().rdd.getNumPartitions() == 3  # an edge table
    assert same(clean.clean_metro(taps, hot_threshold=None), clean.clean_metro(taps, hot_threshold=500, rows_per_chunk=10))


def test_no_hot_card_day_takes_one_job(spark):
    """Nothing hot: the facts of stations and card-days come from one query, and that is all."""
    tf = TapFlow(spark, SF001)
    facts = tf._facts
    spark.sparkContext.setJobGroup("facts", "facts")
    try:
        assert tf.hot is None and tf.site_facts.bus_rows > 0 and tf._trip_keys.strings is None
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("facts")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    taps = tf.inputs["bus_rides"].select("card_id", "trade_date").unionByName(tf.inputs["metro_taps"].select("card_id", "trade_date"))
    assert facts["cards"]["rows"] == taps.groupBy("card_id", "trade_date").count().agg(F.max("count")).first()[0]
    assert facts["cards"]["multiplicity"] == 0
