"""Plan tests: pushdown reaches the scan, yearly copies prune partitions, Python runs only where
it must (archives, records of a split file, batch enrichment), the upsert's small-source form never shuffles the target."""

import pytest

from ledgerflow.operators import joins
from ledgerflow.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_changed_since_filter_is_pushed_to_scan(spark):
    p = plan(catalog.queries()["changed_since"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_year_range_is_pushed_to_scan(spark):
    p = plan(catalog.queries()["range_publish"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in p


def test_column_pruning_for_flag_join(spark):
    p = plan(catalog.queries()["flag_left_join"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in p


def test_yearly_copy_reads_with_partition_filter(spark):
    p = plan(catalog.queries()["year_bucket_copies"](spark, SF))
    assert "PartitionFilters: [isnotnull(year_bucket" in p


def test_python_workers_only_in_archives_and_enrichment(spark, monkeypatch):
    """Also in the steps that a query runs before it returns its plan."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.pandas.group_ops import PandasGroupedOpsMixin
    used, now = {}, None

    def noted(kind, name):
        plain = getattr(kind, name)

        def run(self, fn, *args, **kwargs):
            used.setdefault(now, set()).add(fn.__module__)
            return plain(self, fn, *args, **kwargs)

        monkeypatch.setattr(kind, name, run)

    for name in ("mapInPandas", "mapInArrow"):
        noted(DataFrame, name)
    for name in ("applyInPandas", "applyInArrow"):
        noted(PandasGroupedOpsMixin, name)
    for now, query in catalog.queries().items():
        p = plan(query(spark, SF))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, now
    # the archives of the two queries are also packed in tasks
    packed = {"ledgerflow.sources.archives", "ledgerflow.plans.snapshots"}
    assert used == {"archive_members": packed, "job_archive_load": packed, "snapshot_one_file": {"ledgerflow.sources.quoted"},
                    "batch_enrich": {"ledgerflow.operators.enrich"}, "job_geocoding": {"ledgerflow.operators.enrich"}}


def test_small_source_upsert_does_not_shuffle_target(spark):
    target = spark.read.parquet(f"{SF}/customer.parquet")
    source = target.where("c_custkey < 10")
    out = joins.upsert(target, source, "c_custkey", ["c_name"], small_source_bytes=1 << 20)
    p = plan(out)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_overlay_never_shuffles_the_report(spark):
    report = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_name")
    out = joins.overlay_rows(report, report.where("c_custkey between 10 and 20"), "c_custkey")
    assert "Exchange" not in plan(out) and out.count() == report.count()


def test_rows_without_a_key_stay_out_of_the_join(spark):
    target = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    source = spark.createDataFrame([(None, "d"), (1, "C"), (2, "e")], "k int, v string")
    for small in (None, 1 << 20):
        out = joins.upsert(target, source, "k", ["v"], small_source_bytes=small)
        assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [(None, "a"), (None, "b"), (None, "d"), (1, "C"), (2, "e")]))
    p = plan(joins.upsert(target, source, "k", ["v"]))
    assert "isnotnull(k" in p
