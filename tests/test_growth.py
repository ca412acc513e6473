"""Work that has to grow no faster than the rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import buffers, geodesic
from tidemark.functions.geometry import is_box, st_intersection_area, st_point, st_polygon, st_rectangle
from tidemark.operators import grid, spatial_join
from tidemark.sources.chunks import ChunkedTable


def squares(spark, n, size):
    x, y = (F.col("id") % 10).cast("double"), (F.col("id") / 10).cast("long").cast("double")
    return spark.range(n).select("id", st_rectangle(x, y, x + size, y + size).alias("geometry"))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_salted_copies_follow_the_rows(spark):
    side = spark.range(200).select("id", F.lit(0).alias("_level"), F.lit(0).cast("long").alias("_cx"),
                                   F.lit(0).cast("long").alias("_cy"))
    left, right = grid.salt_hot_cells(side, side, 2)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one copy of each of 200 rows per 2 rows of the other side made 20,000
    assert left.count() + right.count() <= 2 * 200 * (2 + int((grid.PIECES_PER_TASK * width) ** 0.5))
    on = [*grid.CELL, "_salt_l", "_salt_r"]
    assert left.select("id", *on).join(right.select(F.col("id").alias("id_b"), *on), on).count() == 200 * 200


@pytest.mark.parametrize("find", [
    lambda a, b: spatial_join.intersects_ref(a, b),
    lambda a, b: spatial_join.dwithin_ref(a, b, 0.25, unit="srid")])
def test_rows_of_a_semi_join_stop_at_their_first_match(spark, find):
    found = find(squares(spark, 60, 0.5), squares(spark, 30, 0.5))
    assert plan_of(found).count("LeftSemi") == 2
    assert sorted(r["id"] for r in found.select("id").collect()) == list(range(30))


def test_boxes_share_a_box(spark):
    lone = st_polygon([(0.0, 0.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)])
    a, b = st_rectangle(0.0, 0.0, 2.0, 3.0), st_rectangle(1.0, 1.0, 5.0, 5.0)
    row = spark.range(1).select(is_box(a), is_box(lone), is_box(st_point(1.0, 1.0)), st_intersection_area(a, b)).first()
    assert tuple(row) == (True, False, False, 2.0)


def test_equal_shapes_are_united_once(monkeypatch):
    made, around = [], buffers._around
    monkeypatch.setattr(buffers, "_around", lambda *key: made.append(1) or around(*key))
    seen = {}
    for k in range(30):
        x, y = k * 0.1 - 180, k * 0.3 - 85
        ring = [(x, y), (x + 3, y), (x + 3, y + 1), (x + 1, y + 1), (x + 1, y + 3), (x, y + 3), (x, y)]
        parts = buffers.buffer_parts("POLYGON", [[ring]], 0.5, seen)
        assert min(v[0] for v in parts[0][0]) == pytest.approx(x - 0.5, abs=1e-9)
    assert len(made) == 1


def test_points_need_no_edge_pairs(spark):
    a, b = st_point(F.lit(10.0), F.lit(12.0)), st_point(F.lit(11.0), F.lit(13.0))
    near = spark.range(1).select(geodesic.distance_m(a, b, "spheroid", "POINT", "POINT").alias("d"))
    assert "_edge_distance_udf" not in plan_of(near)
    assert near.first()["d"] == pytest.approx(float(geodesic.inverse([10.0], [12.0], [11.0], [13.0])[0][0]))


def test_small_files_are_dealt_to_all_tasks(spark):
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert grid.dealt(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == width


def test_a_stream_has_as_many_batches_whatever_its_files(spark, tmp_path):
    from suite import streams

    events = spark.range(40, numPartitions=4).select(F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    _, stream = streams._as_files(spark, str(tmp_path), str(tmp_path / "out"))
    seen = []
    stream.writeStream.foreachBatch(lambda batch, k: seen.append(batch.count())).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) <= 3 and sum(seen) == 40


def test_new_partitions_are_added_by_the_hundred(spark, tmp_path, monkeypatch):
    table = ChunkedTable(spark, f"growth_{uuid.uuid4().hex[:8]}", "ts", "1 day", ("user", {"chunk_interval": 1}))
    rows = spark.range(20).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user"))
    table.create(rows, str(tmp_path / "t"), migrate_data=True)
    said, run = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or run(text, *a, **k))
    table.upsert(rows.withColumn("user", F.col("user") + 100), ["id", "ts"])
    assert sum("ADD IF NOT EXISTS" in s for s in said) == 1
    monkeypatch.undo()
    assert sorted(r["user"] for r in table.read().collect()) == list(range(100, 120))


def test_moving_partitions_takes_as_many_statements_whatever_their_number(spark, tmp_path, monkeypatch):
    def said(users):
        at = tmp_path / str(users)
        table = ChunkedTable(spark, f"growth_{uuid.uuid4().hex[:8]}", "ts", "1 day", ("user", {"chunk_interval": 1}))
        rows = spark.range(users).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"),
                                         F.when(F.col("id") != 1, F.col("id")).alias("user"))
        table.create(rows, str(at), migrate_data=True)
        out, run = [], spark.sql
        with monkeypatch.context() as held:
            held.setattr(type(spark), "sql", lambda self, text, *a, **k: out.append(text) or run(text, *a, **k))
            # the row without a user moves to the last one's partition, all others are rewritten in place
            table.upsert(rows.withColumn("user", F.coalesce("user", F.lit(users - 1))), ["id", "ts"])
        assert sorted(tuple(r) for r in table.read().select("id", "user").collect()) == [
            (k, users - 1 if k == 1 else k) for k in range(users)]
        assert len(table.chunks()) == users - 1
        # the files that were replaced are gone, and so is the table beside
        assert len([p for p in at.rglob("*.parquet")]) == users - 1
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table.name}_")]
        return len(out)

    assert said(4) == said(40)


def test_an_upsert_reads_many_small_files_in_a_task(spark, tmp_path):
    table = ChunkedTable(spark, f"growth_{uuid.uuid4().hex[:8]}", "ts", "1 day", ("user", {"chunk_interval": 1}))
    rows = spark.range(2000).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user"))
    table.create(rows, str(tmp_path / "t"), migrate_data=True)
    found = table._table().filter("chunk_start > timestamp_ntz '2023-01-01'")
    assert found.rdd.getNumPartitions() > 50
    assert table._gathered(found).rdd.getNumPartitions() <= 4 * table._cores()
    listed = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert int(listed) <= 8 * table._cores()
