"""Keys and links audited load by load, without reading again what was loaded before.

The audits count, for each hashed key, the rows that hold it and the links that point at it. These counts are kept: a load's own are written
as a run, dealt to buckets by key, and its audit reads the load and, of earlier runs, only the buckets that its keys fall in. Entries are
moved once, to be counted; all runs are dealt to files alike, as a bucketed table is, so that they meet file by file. A key's faults
before and after the load differ only where the load holds the key, so the totals of the version before and those differences
are the totals of a full audit; a child that came before its parent is an orphan until the parent's load. Runs are published as
versions: a load that fails leaves the totals and the counts as they were.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waferscope.operators.cohort import Tables
from waferscope.plans.audits import QUESTIONS, SLOTS, bad_of, entries_of, held_per_key, place_of
from waferscope.sources.inline import inline_rows

RUNS = "_runs"
_RUNS_DDL = "number bigint, folder string, whole boolean, buckets int, files int, question int, held bigint, bad bigint"
_KEY = ["space", "key", "more"]
_HELD = [f"held{i}" for i in range(SLOTS)]
_STATE_DDL = "space int, key bigint, more int, " + ", ".join(f"{c} bigint" for c in _HELD) + ", bucket int"
_NO_BUCKETS = 1_024


def _published(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_RUNS_DDL).parquet(f"{root}/{RUNS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _RUNS_DDL)


def _last(spark: SparkSession, root: str) -> tuple[int, dict[int, tuple[int, int]], tuple[int, int] | None]:
    """The last version's number, its totals by question, and the number of buckets and of files; rows are few, one for each question."""
    runs = _published(spark, root)
    rows = runs.filter(F.col("number") == runs.agg(F.max("number")).scalar()).collect()
    if len({row.folder for row in rows}) > 1:
        raise ValueError(f"two loads of {root} were published at once as version {rows[0].number}")
    if any(row.files is None for row in rows):
        raise ValueError(f"the runs of {root} were written by an earlier layout, with other hashes: load them anew")
    totals = {row.question: (row.held, row.bad) for row in rows}
    return (rows[0].number if rows else 0), totals, ((rows[0].buckets, rows[0].files) if rows else None)


def _folders(spark: SparkSession, root: str) -> list[str]:
    """The runs published so far, from the last whole one on."""
    named = _published(spark, root).select("number", "folder", "whole").distinct()
    # One row for each run since the last whole one.
    since = named.filter(F.col("number") >= F.coalesce(named.filter("whole").agg(F.max("number")).scalar(), F.lit(0)))
    return [row.folder for row in since.orderBy("number").collect()]


def _state(spark: SparkSession, root: str) -> DataFrame | None:
    """The counts of the runs published so far, from the last whole one on; None before the first."""
    runs = [spark.read.schema(_STATE_DDL).parquet(f"{root}/{folder}") for folder in _folders(spark, root)]
    return reduce(DataFrame.unionByName, runs) if runs else None


def _files(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _table(spark: SparkSession, folder: str) -> str:
    return f"{spark.catalog.currentDatabase()}.key_{folder.replace('-', '_')}"


def _write(counts: DataFrame, root: str, folder: str, buckets: int, files: int) -> DataFrame:
    """Counts per key as a run, a bucketed table. They come dealt by key, which is how its files are, if there are as many."""
    spark = counts.sparkSession
    place = F.pmod(F.hash(*_KEY), F.lit(files * max(1, buckets // files)))
    bucket = F.pmod(place, F.lit(buckets)).cast("int").alias("bucket")
    dealt = counts if files == _files(spark) else counts.repartition(files, *_KEY)
    writer = dealt.select(*_KEY, *_HELD, bucket).write.partitionBy("bucket").bucketBy(files, *_KEY)
    writer.format("parquet").option("path", f"{root}/{folder}").saveAsTable(_table(spark, folder))
    return spark.table(_table(spark, folder))


def _opened(spark: SparkSession, root: str, folder: str, files: int) -> DataFrame:
    """A run written before as the bucketed table that it is, named in the catalogue of a session that does not know it yet."""
    table = _table(spark, folder)
    if spark.catalog.tableExists(table):
        return spark.table(table)
    spark.sql(
        f"CREATE TABLE {table} ({_STATE_DDL}) USING parquet PARTITIONED BY (bucket) "
        f"CLUSTERED BY ({', '.join(_KEY)}) INTO {files} BUCKETS LOCATION '{root}/{folder}'"
    )
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


def _publish(
    spark: SparkSession, root: str, number: int, folder: str, whole: bool, shape: tuple[int, int], totals: dict[int, tuple[int, int]]
) -> None:
    rows = [(number, folder, whole, *shape, q.number, *totals.get(q.number, (0, 0))) for q in QUESTIONS]
    # A single file, which is there with all its rows or not at all.
    spark.createDataFrame(rows, _RUNS_DDL).coalesce(1).write.mode("append").parquet(f"{root}/{RUNS}")


def _beside(run: DataFrame, earlier: list[DataFrame]) -> DataFrame:
    """The keys of a run with what each earlier run holds of them. A missing key meets nothing: each of its rows is at fault
    whatever came before."""
    met = run.select(*_KEY, *_HELD)
    for number, one in enumerate(earlier):
        met = met.join(one.select(*_KEY, *[F.col(c).alias(f"{c}_{number}") for c in _HELD]), _KEY, "left")
    return met


def _sums(runs: DataFrame, earlier: int) -> DataFrame:
    """Per key of the new run the rows it held before and holds with it."""

    def before(c: str) -> Column:
        return reduce(lambda a, b: a + b, [F.coalesce(f"{c}_{i}", F.lit(0)) for i in range(earlier)], F.lit(0).cast("long"))

    return runs.select(*_KEY, *[before(c).alias(f"old_{c}") for c in _HELD], *[(before(c) + F.col(c)).alias(c) for c in _HELD])


def _change(per_key: DataFrame) -> dict[tuple[int, int], tuple[int, int]]:
    """For each place of a question the rows that a load adds and how far it moves the bad ones."""
    before, after = bad_of(lambda i: F.col(f"old_held{i}")), bad_of(lambda i: F.col(f"held{i}"))
    changes = [
        F.struct(
            F.lit(i).alias("slot"),
            F.sum(F.col(f"held{i}") - F.col(f"old_held{i}")).alias("held"),
            F.sum(F.coalesce(after[i], F.lit(0)) - F.coalesce(before[i], F.lit(0))).alias("bad"),
        )
        for i in range(SLOTS)
    ]
    # One row for each key of the contract and each link to it.
    found = per_key.groupBy("space").agg(F.array(*changes).alias("changes")).select("space", F.inline("changes")).collect()
    return {(row.space, row.slot): (row.held, row.bad) for row in found}


def audit_load(tables: Tables, root: str, buckets: int = _NO_BUCKETS) -> int:
    """Add a load's rows to the counts kept under ``root`` and return the version's number.

    The first load fixes the number of buckets and, by the session's shuffle partitions, of files in a run. Runs are
    external tables of the session's catalogue, from where they may be dropped: the files stay and name them anew. One load at a time: if two are
    published at once, both take the same number and the next reader refuses it. A load without any key of the contract changes nothing
    but the number.
    """
    spark = next(iter(tables.values())).sparkSession
    number, totals, kept = _last(spark, root)
    shape = kept or (buckets, _files(spark))
    folder = f"run-{number + 1}-{uuid.uuid4().hex}"
    entries = entries_of(tables)
    if entries is None:
        entries = spark.createDataFrame([], "space int, slot int, key bigint, more int, found bigint")
    folders = _folders(spark, root)
    run = _write(held_per_key(entries), root, folder, *shape)
    # At most one row for each bucket.
    touched = [row.bucket for row in run.select("bucket").distinct().collect()]
    earlier = [_opened(spark, root, one, shape[1]).filter(F.col("bucket").isin(touched)) for one in folders]
    change = _change(_sums(_beside(run, earlier), len(earlier)))
    summed = {}
    for question in QUESTIONS:
        held, bad = totals.get(question.number, (0, 0))
        more_held, more_bad = change.get(place_of(question), (0, 0))
        summed[question.number] = (held + more_held, bad + more_bad)
    _publish(spark, root, number + 1, folder, False, shape, summed)
    return number + 1


def merge_runs(spark: SparkSession, root: str) -> int:
    """Put all runs together as one, with a row for each key, and return the new version's number; totals stay. Later loads
    read that run instead of the many before it."""
    number, totals, shape = _last(spark, root)
    state = _state(spark, root)
    if state is None:
        raise ValueError(f"nothing was loaded in {root}")
    folder = f"run-{number + 1}-{uuid.uuid4().hex}"
    _write(state.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in _HELD]), root, folder, *shape)
    _publish(spark, root, number + 1, folder, True, shape, totals)
    return number + 1


def key_report(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """``table_name, key, parent_table, rows, bad``: for every key and link of the contract the rows loaded up to a version, the last
    without a number, and those that are surplus, incomplete or without a parent; rows with a null link count as loaded."""
    runs = _published(spark, root)
    wanted = F.lit(number) if number is not None else runs.agg(F.max("number")).scalar()
    named = inline_rows(
        spark,
        "question int, table_name string, key string, parent_table string",
        [(q.number, q.table, q.text, q.parent) for q in QUESTIONS],
    )
    found = runs.filter(F.col("number") == wanted).select("question", F.col("held").alias("rows"), "bad")
    return named.join(found, "question").select("table_name", "key", "parent_table", "rows", "bad")
