"""A refresh is seen whole or not at all."""

from __future__ import annotations

import pytest
from conftest import rows, wafers
from pyspark.sql import functions as F
from waferscope.sources import parquet
from waferscope.sources.versions import MANIFEST, publish_fab, published_versions, read_published, version_check


def ids(tables, name: str = "wafers") -> list[int]:
    return sorted(r[0] for r in rows(tables[name].select(tables[name].columns[0])))


def test_readers_follow_the_last_version_and_keep_theirs(fab, tmp_path, spark):
    root = str(tmp_path)
    assert published_versions(spark, root).count() == 0
    assert publish_fab(fab(wafers=wafers(1, 2)), root) == 1
    held = read_published(spark, root)
    before = held["wafers"]
    assert publish_fab(fab(wafers=wafers(7)), root) == 2
    assert ids(held) == [1, 2] and sorted(r.wafer_id for r in before.collect()) == [1, 2]
    assert ids(read_published(spark, root)) == [7] and ids(read_published(spark, root, 1)) == [1, 2]


def test_a_refresh_that_fails_between_two_tables_is_not_seen(fab, tmp_path, spark):
    root = str(tmp_path)
    publish_fab(fab(wafers=wafers(1, 2)), root)
    broken = fab(wafers=wafers(3, 4, 5))
    broken["process_runs"] = broken["wafers"].select(
        F.raise_error(F.lit("the source broke")).cast("long").alias("process_run_id"), "wafer_id", F.lit(1).alias("process_step_id"),
        F.lit(1).alias("tool_id"), F.lit(1).alias("chamber_id"), F.current_timestamp().alias("run_start"),
    )
    with pytest.raises(Exception, match="the source broke"):
        publish_fab(broken, root)
    written = [p for p in tmp_path.glob("version-2-*/wafers/*.parquet")]
    assert written, "the new wafers were written before the failure"
    assert ids(read_published(spark, root)) == [1, 2]
    assert {r.status for r in version_check(spark, root).collect()} == {"OK"}
    # The next refresh takes the number that was never published.
    assert publish_fab(fab(wafers=wafers(9)), root) == 2 and ids(read_published(spark, root)) == [9]


def test_tables_that_a_refresh_lacks_are_carried_over(fab, tmp_path, spark):
    root = str(tmp_path)
    publish_fab(fab(wafers=wafers(1, 2)), root)
    publish_fab({"tools": fab()["tools"].limit(1)}, root)
    now = read_published(spark, root)
    assert ids(now) == [1, 2] and len(ids(now, "tools")) == 1
    counts = {r.table_name: (r.number, r.expected, r.actual, r.status) for r in version_check(spark, root).collect()}
    assert len(counts) == 12 and counts["tools"] == (2, 1, 1, "OK") and counts["wafers"] == (2, 2, 2, "OK")


def test_a_table_that_lost_rows_is_reported(fab, tmp_path, spark):
    root = str(tmp_path)
    publish_fab(fab(wafers=wafers(1, 2, 3)), root)
    (folder,) = {r.folder for r in published_versions(spark, root).collect()}
    fab(wafers=wafers(1))["wafers"].write.mode("overwrite").parquet(f"{root}/{folder}/wafers")
    assert [(r.table_name, r.expected, r.actual) for r in version_check(spark, root).collect() if r.status != "OK"] == [("wafers", 3, 1)]


def test_two_refreshes_at_once_and_unknown_versions_are_refused(fab, tmp_path, spark):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, root)
    with pytest.raises(ValueError, match="needs a table"):
        publish_fab({}, root)
    publish_fab(fab(), root)
    with pytest.raises(ValueError, match="no version 5"):
        read_published(spark, root, 5)
    published_versions(spark, root).limit(1).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    with pytest.raises(ValueError, match="at once"):
        read_published(spark, root)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        shared = None

        def get(self, name, default):
            return self.shared

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        parquet.scratch_folder(Session())
    Context.master = "local[4]"
    assert parquet.scratch_folder(Session()).startswith("file://")
    Context.master, Conf.shared = "yarn", "hdfs://a/b/"
    assert parquet.scratch_folder(Session()).startswith("hdfs://a/b/fab-")
