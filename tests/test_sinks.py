"""Record tables: buckets that split, versions, failures, removal."""

import pytest
from pyspark.sql import functions as F

from sparkretrieve.sources import sinks, snapshots
from sparkretrieve.sources.sinks import RecordTable, read_table, upsert_table


def _rows(spark, ids, word="x"):
    return spark.createDataFrame([(f"id{i}", f"{word} {i} " + "pad " * 20, {"k": word}) for i in ids],
                                 "id string, text string, metadata map<string,string>")


def _content(table):
    return {r.id: r.text.split()[0] for r in table.collect()}


def test_buckets_split_as_the_table_grows_and_only_then(spark, tmp_path):
    path = str(tmp_path / "t")
    counts = []
    for k in range(4):
        upsert_table(_rows(spark, range(k * 50, k * 50 + 50)), path, "id", bucket_bytes=4000)
        counts.append(len(RecordTable(spark, path).buckets))
    assert counts == sorted(counts) and counts[-1] > counts[0] > 1
    table = RecordTable(spark, path)
    assert max(b["bytes"] for b in table.buckets) <= 4000
    assert sum(b["rows"] for b in table.buckets) == 200 == len(_content(table.rows()))
    for _ in range(3):  # replaced rows do not add up
        upsert_table(_rows(spark, range(200), "y"), path, "id")
    again = RecordTable(spark, path)
    assert len(again.buckets) == counts[-1] and set(_content(again.rows()).values()) == {"y"}
    named = again.with_bucket(spark.createDataFrame([("id7",), ("id199",)], "id string"), "id").join(again.rows(True), ["bucket", "id"])
    assert named.count() == 2


def test_untouched_buckets_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(_rows(spark, range(100)), path, "id", bucket_bytes=4000)
    before = {(b["depth"], b["suffix"]): b["folder"] for b in RecordTable(spark, path).buckets}
    upsert_table(_rows(spark, [5], "new"), path, "id")
    after = {(b["depth"], b["suffix"]): b["folder"] for b in RecordTable(spark, path).buckets}
    assert sum(before[k] != after[k] for k in before) == 1 and before.keys() == after.keys()


def test_readers_see_one_version_and_a_dead_job_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None
    upsert_table(_rows(spark, range(20), "old"), path, "id")
    reading = read_table(spark, path)  # begun before the upsert, read after it
    upsert_table(_rows(spark, range(10, 30), "new"), path, "id")
    assert _content(reading) == {f"id{i}": "old" for i in range(20)}
    now = {f"id{i}": "old" if i < 10 else "new" for i in range(30)}
    assert _content(read_table(spark, path)) == now

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "publish", dies)
        with pytest.raises(RuntimeError, match="killed"):
            upsert_table(_rows(spark, range(30), "lost"), path, "id")
    assert _content(read_table(spark, path)) == now
    assert _content(RecordTable(spark, path, 1).rows()) == {f"id{i}": "old" for i in range(20)}
    assert sinks.drop_old_versions(spark, path) >= 1
    assert snapshots.versions(spark, path) == [2] and _content(read_table(spark, path)) == now


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    base = str(tmp_path / "v")
    assert snapshots.publish(spark, base, {"a": 1}, 0) == 1
    with pytest.raises(snapshots.VersionTaken):
        snapshots.publish(spark, base, {"a": 2}, 0)
    assert snapshots.read_version(spark, base) == (1, {"a": 1})


def test_removal_empty_batches_and_other_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_table(_rows(spark, range(10)), path, "id")
    upsert_table(_rows(spark, [3], "new"), path, "id", remove=spark.createDataFrame([("id1",), ("none",)], "id string"))
    assert _content(read_table(spark, path)) == {f"id{i}": "new" if i == 3 else "x" for i in range(10) if i != 1}
    upsert_table(_rows(spark, range(10)).limit(0), path, "id")
    assert len(_content(read_table(spark, path))) == 9
    upsert_table(_rows(spark, range(10)).limit(0), path, "id", remove=_rows(spark, range(10)).select("id"))
    assert read_table(spark, path).count() == 0
    upsert_table(_rows(spark, [1]), path, "id")
    assert read_table(spark, path).count() == 1
    with pytest.raises(ValueError, match="columns"):
        upsert_table(_rows(spark, [1]).withColumn("more", F.lit(1)), path, "id")


def test_new_ids_are_added_without_writing_old_rows_again(spark, tmp_path, monkeypatch):
    """Batches of new ids cost what they hold: what a bucket has stays where it is until it has many folders and has doubled."""
    path = str(tmp_path / "t")
    upsert_table(_rows(spark, range(50)), path, "id", bucket_bytes=1 << 20)
    first = RecordTable(spark, path).buckets[0]["folder"]
    for k in range(1, 4):
        upsert_table(_rows(spark, range(k * 50, k * 50 + 50)), path, "id")
        bucket, = RecordTable(spark, path).buckets
        assert bucket["folder"] == first and len(bucket["runs"]) == k and bucket["rows"] == (k + 1) * 50
    assert _content(read_table(spark, path)) == {f"id{i}": "x" for i in range(200)}
    # Ids that are not there: nothing is written anew. One that is: the bucket is one folder again.
    upsert_table(_rows(spark, []), path, "id", remove=spark.createDataFrame([("none",)], "id string"))
    assert RecordTable(spark, path).buckets == [bucket]
    upsert_table(_rows(spark, [7], "new"), path, "id", remove=spark.createDataFrame([("id8",)], "id string"))
    again, = RecordTable(spark, path).buckets
    assert again["runs"] == [] and again["folder"] != first and again["rows"] == 199
    assert _content(read_table(spark, path)) == {f"id{i}": "new" if i == 7 else "x" for i in range(200) if i != 8}
    monkeypatch.setattr(sinks, "MAX_RUNS", 1)
    upsert_table(_rows(spark, range(200, 210)), path, "id")
    upsert_table(_rows(spark, range(210, 500)), path, "id")  # one folder more, though there are enough: not doubled yet
    assert len(RecordTable(spark, path).buckets[0]["runs"]) == 2
    upsert_table(_rows(spark, [500]), path, "id")
    assert RecordTable(spark, path).buckets[0]["runs"] == [] and read_table(spark, path).count() == 500
    assert sinks.drop_old_versions(spark, path) >= 6 and read_table(spark, path).count() == 500
