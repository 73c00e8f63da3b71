"""Relations that several results or tables read are made once."""

import pytest

from bazaarlens import session
from bazaarlens.operators import baskets
from bazaarlens.plans import queries_ingest, queries_money
from bazaarlens.sources import fixtures, raw_fixtures, tables as at_rest
from bazaarlens.sources.fixtures import Fixture
from bazaarlens.sources.tables import Store, read_tables, upsert_tables


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def written(monkeypatch):
    """Plans of the relations that are written meanwhile."""
    seen = []
    monkeypatch.setattr(fixtures, "materialise", lambda df, name="table": (seen.append(plan(df)), session.materialise(df, name))[1])
    return seen


def test_the_windows_lines_are_chosen_once(spark, folder, written):
    fx = Fixture(spark, folder)
    queries_money.QUERIES["category_margin"](fx)
    assert sum("lineitem.parquet" in p for p in written) == 1


def test_sales_of_the_window_are_the_same_from_written_lines(spark, folder):
    lazy, shared = Fixture(spark, folder).sales.drop("reasons"), Fixture(spark, folder).sales_table.drop("reasons")
    assert lazy.dtypes == shared.dtypes and lazy.count() > 0
    assert lazy.exceptAll(shared).count() == 0 and shared.exceptAll(lazy).count() == 0


def test_exports_and_sheets_read_written_relations(spark, folder):
    found = queries_ingest.fixture_tables(Fixture(spark, folder))
    assert "lineitem.parquet" not in plan(found["order_lines"]) and "lineitem.parquet" not in plan(found["distribution"])
    assert all("lineitem.parquet" not in plan(s) for s in raw_fixtures.raw_sheets(Fixture(spark, folder)).values())


def test_order_rows_come_again_without_a_second_join(spark, folder):
    export = raw_fixtures.order_export(Fixture(spark, folder))
    assert export._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1


def test_a_batch_for_new_folders_is_not_ranked_again(spark, tmp_path, monkeypatch):
    root, plans, write = str(tmp_path / "t"), [], Store.write
    monkeypatch.setattr(Store, "write", lambda self, name, rows, replaced=None: (plans.append(plan(rows)), write(self, name, rows, replaced))[1])
    rows = lambda month, qty: spark.createDataFrame([(month, "b", qty)], "period string, barcode string, net_sales_qty int").withColumn("period", at_rest.F.to_date("period"))
    for month, qty, ranked in (("2026-05-01", 1, False), ("2026-06-01", 2, False), ("2026-05-01", 3, True)):
        plans.clear()
        upsert_tables({"sales_monthly": rows(month, qty)}, root, 2)
        assert ("Window" in plans[0]) == ranked
    assert sorted(r["net_sales_qty"] for r in read_tables(spark, root)["sales_monthly"].collect()) == [2, 3]


def test_dealt_tasks_follow_the_rows(spark):
    tasks = {(n, r): session.dealt(spark.range(n), "id", rows=r) for n, r in ((95, 10), (95, 95), (95, 1000), (0, 10))}
    assert [df.rdd.getNumPartitions() for df in tasks.values()] == [10, 1, 1, 1]
    assert [df.count() for df in tasks.values()] == [95, 95, 95, 0]
    table = session.materialise(spark.range(95).coalesce(1), file_rows=10)
    assert len(table.inputFiles()) == 10 and table.count() == 95


@pytest.mark.parametrize("made", [baskets.multicolor_packages, baskets.multicolor_models, lambda lines: baskets.saved_items(lines, "model")])
def test_lines_are_rolled_up_once_and_apart_from_their_grouping(spark, folder, monkeypatch, made):
    seen = []
    write = session.materialise
    for module in (session, baskets):
        monkeypatch.setattr(module, "materialise", lambda df, *how: (seen.append(plan(df)), write(df, *how))[1])
    found = made(Fixture(spark, folder).lines)
    assert sum("lineitem.parquet" in p for p in seen) == 1 and "lineitem.parquet" not in plan(found)
    rolled = next(p for p in seen if "lineitem.parquet" in p)
    # the roll-up alone: no grouping by model in the job that makes the lines
    assert rolled.split("== Physical Plan ==")[0].split("== Optimized Logical Plan ==")[1].count("Aggregate [") == 1


def test_multicolor_on_odd_rows(spark):
    lines = spark.createDataFrame(
        [("p", "b1", "m"), ("p", "b2", "m"), ("p", "b3", "n"), (None, "b1", "m"), (None, "b2", "m"), ("q", None, "m"), ("q", "b4", "m"), ("r", "b1", "n"), ("s", "b1", None), ("s", "b2", None)],
        "package_no string, barcode string, model string")
    # a null barcode is no second one; packages without a number are one package
    assert [tuple(r) for r in baskets.multicolor_packages(lines).collect()] == [(3, 5)]
    assert sorted(tuple(r) for r in baskets.multicolor_models(lines).collect()) == [("m", 2, 2 / 3 * 100.0)]
    assert baskets.multicolor_models(lines, k=1).count() == 1 and [tuple(r) for r in baskets.multicolor_packages(lines.limit(0)).collect()] == [(0, 0)]
