"""Replace and heal by file: only files with a touched row are written anew."""

import pytest

from erpspark.plans import core, runner
from erpspark.sources import sinks

DDL = "id bigint, v bigint, year int"


@pytest.fixture
def stored(spark, database):
    """Three years of four files each: ids 0..119, ten per file."""
    table = f"{database('files')}.fact_x"
    for part in range(4):
        rows = [(y * 40 + part * 10 + i, 0, 2020 + y) for y in range(3) for i in range(10)]
        sinks.append_rows(spark.createDataFrame(rows, DDL).coalesce(1), table, "year", "id")
    return table


def _files(spark, table):
    return {r[0] for r in sinks.with_file(spark.table(table)).select(sinks.FILE).distinct().collect()}


def _values(spark, table):
    return {r["id"]: (r["v"], r["year"]) for r in spark.table(table).collect()}


@pytest.mark.parametrize("limit", [200, 0])  # keys as values of the scan, keys joined
def test_replace(spark, stored, monkeypatch, limit):
    monkeypatch.setattr(sinks, "POINT_KEYS", limit)
    before, values = _files(spark, stored), _values(spark, stored)
    assert len(before) == 12
    # ids 3 and 4 share a file; 45 moves to another year; 500 is new, in a year of its own; NULL is no key
    batch = spark.createDataFrame([(3, 1, 2020), (4, 1, 2020), (45, 2, 2022), (500, 3, 2031), (None, 9, 2020)], DDL)
    for nulls in (1, 2):  # repeated: only rows without a key come twice
        assert runner.replace_rows(spark.table(stored), batch, "id", stored) == 5
        assert len(before - _files(spark, stored)) == 2
        want = values | {3: (1, 2020), 4: (1, 2020), 45: (2, 2022), 500: (3, 2031), None: (9, 2020)}
        assert _values(spark, stored) == want
        assert spark.table(stored).count() == 121 + nulls


def test_replace_without_rows(spark, stored):
    before = _files(spark, stored)
    assert runner.replace_rows(spark.table(stored), spark.createDataFrame([], DDL), "id", stored) == 0
    assert _files(spark, stored) == before and spark.table(stored).count() == 120


def test_untouched_files_are_not_opened(spark, stored):
    some = sorted(_files(spark, stored))[:2]
    part = sinks.in_files(spark.table(stored), some)
    assert part.count() == 20
    part.collect()
    scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 2


@pytest.mark.parametrize("moved, deleted", [(0, 0), (1, 0), (2, 0), (2, 1)])
def test_swap_that_broke_off(spark, stored, monkeypatch, moved, deleted):
    batch = spark.createDataFrame([(3, 1, 2020), (45, 2, 2033)], DDL)
    files = sinks.files_holding(spark.table(stored), batch, "id")
    new = runner.replace_by_key(sinks.in_files(spark.table(stored), files), batch, "id").coalesce(1)
    # decided, then lost: some files are moved and deleted, the rest is not
    monkeypatch.setattr(sinks, "finish_file_swap", lambda *_: None)
    sinks.replace_files(new, stored, files, "id")
    monkeypatch.undo()
    root = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {stored}").collect() if r["col_name"] == "Location")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    for name in spark.table(f"{stored}__part").inputFiles()[:moved]:
        source = path(jvm.java.net.URI(name))
        folder = path(root, source.getParent().getName())
        system = folder.getFileSystem(conf)
        system.mkdirs(folder)
        assert system.rename(source, path(folder, source.getName()))
    for name in files[:deleted]:
        old = path(jvm.java.net.URI(name))
        assert old.getFileSystem(conf).delete(old, False)
    assert sinks.exists(spark, stored)
    values = _values(spark, stored)
    assert spark.table(stored).count() == 120 and values[3] == (1, 2020) and values[45] == (2, 2033)
    assert not spark.catalog.tableExists(f"{stored}__swap") and not spark.catalog.tableExists(f"{stored}__part")


def test_heal_by_file(spark, database):
    """Orders without a known customer lie in one file of two; only that one is written anew."""
    table = f"{database('files')}.fact_orders"
    ddl = "order_id bigint, customer_key bigint, employee_key bigint, year int"
    for rows in ([(1, 1, 1), (2, 2, 1)], [(3, None, 1), (4, 2, 1)]):
        sinks.append_rows(spark.createDataFrame([(*r, 2020) for r in rows], ddl).coalesce(1), table, "year", "order_id")
    before = _files(spark, table)
    fresh = spark.createDataFrame([(1, 8, 8), (3, 7, None)], "order_id bigint, customer_key bigint, employee_key bigint")
    assert runner.heal_rows(spark.table(table), fresh, core.FACTS["fact_orders"], "fact_orders", table) == 1
    assert {r["order_id"]: r["customer_key"] for r in spark.table(table).collect()} == {1: 1, 2: 2, 3: 7, 4: 2}
    assert len(before & _files(spark, table)) == 1
