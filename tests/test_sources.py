"""Extract, cleaning, state, sinks and the stream."""

import os
from datetime import date, datetime

import pytest

from erpspark.catalog import quality_queries
from erpspark.plans import quality
from erpspark.sources import cleaning, pipeline, sinks, state, tables
from erpspark.streaming.incremental import insert_writer, stream_incremental, stream_to_folder, upsert_writer
from util import frame, rows

NOW = datetime(2024, 5, 1)


def test_incremental_is_inclusive_and_typed(spark):
    df = frame(spark, "id bigint, d timestamp", [(9, datetime(2024, 1, 1)), (10, datetime(2024, 1, 2)), (100, None)])
    assert rows(tables.incremental_load(df, "id", "10"), "id") == [(10,), (100,)]
    assert rows(tables.incremental_load(df, "d", "2024-01-02"), "id") == [(10,)]
    assert rows(tables.incremental_load(df, "d", "2000-01-01"), "id") == [(9,), (10,), (100,)]
    plan = tables.incremental_load(df, "id", "10")._jdf.queryExecution().optimizedPlan().toString()
    assert "coalesce" not in plan


def test_next_mark(spark):
    df = frame(spark, "id bigint, d timestamp", [(9, None), (10, None)])
    assert tables.next_mark(df, "id", "0", "now") == "10"
    assert tables.next_mark(df, "d", "2020-01-01 00:00:00", "now") == "2020-01-01 00:00:00"
    assert tables.next_mark(df, None, "x", "now") == "now"
    assert tables.default_mark("id") == "0" and tables.default_mark("date") == "2020-01-01 00:00:00"
    assert len(tables.WATERMARKS) == 29 and sum(v is not None for v in tables.WATERMARKS.values()) == 11


def test_state(spark):
    s = state.set_mark(state.empty_state(spark), "a", "2024-01-01", NOW)
    s = state.set_mark(state.set_mark(s, "b", "5", NOW), "a", "2024-02-01", NOW)
    assert state.get_mark(s, "a", "x") == "2024-02-01" and state.get_mark(s, "c", "x") == "x"
    assert rows(state.reset_marks(s, "a"), "table_name") == [("b",)]
    assert rows(state.reset_marks(s, None, "0"), "last_loaded_at") == [("0",), ("0",)]


def test_cleaning(spark):
    df = frame(
        spark, "order string, Default int, d string, whole double, part double, empty double",
        [("0000-00-00", 1, "0000-00-00 00:00:00", 1, 1.5, None), ("x", 2, "2024-01-01", None, 2, None)],
    )
    out = cleaning.clean_batch(df, NOW)
    assert out.columns == ["order_col", "Default_col", "d", "whole", "part", "empty", "etl_loaded_at"]
    assert dict(out.dtypes)["whole"] == "bigint" and dict(out.dtypes)["part"] == "double" and dict(out.dtypes)["empty"] == "double"
    assert rows(out, "order_col", "d") == [(None, None), ("x", "2024-01-01")]


def test_schema_evolution_notes(spark):
    stored = frame(spark, "a int, b int, t string", [(1, 1, "x")])
    batch = frame(spark, "a bigint, b string, t int, c double", [(2**40, "no", 5, 1)])
    aligned, notes = cleaning.align_to(batch, stored.schema)
    assert notes == {"a": "widened", "b": "skipped", "c": "added"}
    assert rows(cleaning.evolve(stored, batch), "a", "b", "t", "c") == [(1, 1, "x", None), (2**40, None, "5", 1.0)]


def test_csv_with_header_and_bom(spark, tmp_path):
    path = str(tmp_path / "s.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("id,city,amount\n1,,2.5\n2,abc,\n")
    df = tables.read_csv(spark, path, "id int, city string, amount decimal(22,4)")
    assert rows(df, "id", "city", "amount") == [(1, None, 2.5), (2, "abc", None)]


def test_csv_lines_that_do_not_fit_are_kept_aside(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('\ufeffid,city,amount\n1,,2.5\nx,abc,1\n2,"a,b",\n\n3,short\n', encoding="utf-8")
    (folder / "b.csv").write_text("id,city,amount\n4,é,oops\n5,d,1,extra\n6,,\n", encoding="utf-8")
    (folder / "c.csv").write_text("id,city,amount\n", encoding="utf-8")
    load = tables.load_csv(spark, str(folder), "id int, city string, amount decimal(22,4)", str(tmp_path / "t"))
    assert rows(load.good, "id", "city", "amount") == [(1, None, 2.5), (2, "a,b", None), (6, None, None)]
    assert rows(load.bad, "record", "file", "reason") == [
        ("3,short", "a.csv", "number of fields"), ("4,é,oops", "b.csv", "value of amount"), ("5,d,1,extra", "b.csv", "number of fields"), ("x,abc,1", "a.csv", "value of id"),
    ]
    assert (load.n_good, load.n_bad) == (3, 4) and load.good.count() == 3


def test_pipeline_isolates_failures_and_moves_marks(spark, database, tmp_path):
    raw = database("raw")
    source = tables.Source(spark, str(tmp_path))
    frame(spark, "id bigint, date timestamp", [(1, datetime(2024, 1, 1)), (2, datetime(2019, 1, 1))]).write.parquet(str(tmp_path / "tbl_orders"))
    frame(spark, "id bigint, q double", [(1, 2)]).write.parquet(str(tmp_path / "tbl_order_items"))
    os.makedirs(tmp_path / "tbl_deliveries")  # empty folder: unreadable
    only = ["tbl_orders", "tbl_order_items", "tbl_deliveries"]
    first = {r["table_name"]: r for r in pipeline.run_extract(source, raw, NOW, only).collect()}
    assert (first["tbl_orders"]["status"], first["tbl_orders"]["rows"]) == ("ok", 1)
    assert first["tbl_deliveries"]["status"] == "failed" and first["tbl_order_items"]["status"] == "ok"
    marks = spark.table(f"{raw}.{pipeline.STATE}")
    assert state.get_mark(marks, "tbl_orders", "?") == "2024-01-01 00:00:00"
    assert state.get_mark(marks, "tbl_order_items", "?") == "2024-05-01 00:00:00"
    # the boundary row is read again; new columns are added, the table holds the last batch
    frame(spark, "id bigint, date timestamp, extra int", [(1, datetime(2024, 1, 1), 1), (3, datetime(2024, 3, 1), 2)]).write.mode("overwrite").parquet(str(tmp_path / "tbl_orders"))
    pipeline.run_extract(source, raw, NOW, ["tbl_orders"])
    assert rows(spark.table(f"{raw}.tbl_orders"), "id", "extra") == [(1, 1), (3, 2)]
    # nothing new past the mark: the load is skipped and the mark stays
    frame(spark, "id bigint, date timestamp", [(1, datetime(2023, 1, 1))]).write.mode("overwrite").parquet(str(tmp_path / "tbl_orders"))
    again = pipeline.run_extract(source, raw, NOW, ["tbl_orders"]).first()
    assert again["status"] == "skipped"
    assert state.get_mark(spark.table(f"{raw}.{pipeline.STATE}"), "tbl_orders", "?") == "2024-03-01 00:00:00"


def test_year_partitions_are_pruned(spark, database):
    db = database("core")
    df = frame(spark, "id bigint, dk int", [(1, 20230105), (2, 20240105), (3, None)])
    sinks.append_rows(sinks.with_year(df, "dk"), f"{db}.f", "year")
    got = sinks.read_between(spark, f"{db}.f", "dk", 20240101, 20241231)
    assert rows(got, "id") == [(2,)]
    assert "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().executedPlan().toString()
    sinks.replace_partitions(spark.table(f"{db}.f").filter("year = 2024").selectExpr("id + 10 as id", "dk", "year"), f"{db}.f")
    assert rows(spark.table(f"{db}.f"), "id", "year") == [(1, 2023), (3, 0), (12, 2024)]


def test_stream_gives_the_batch_result_also_on_replay(spark, database, tmp_path):
    db = database("stream")
    src = str(tmp_path / "in")
    ddl = "id bigint, v string, seq int"
    first = frame(spark, ddl, [(1, "a", 1), (2, "b", 1), (1, "c", 2)])
    second = frame(spark, ddl, [(2, "late", 0), (3, "0000-00-00", 1)])
    order = ["seq", "v"]
    upsert, insert = upsert_writer(f"{db}.up", "id", order, NOW), insert_writer(f"{db}.ins", "id", order, NOW)
    for n, batch in enumerate((first, second)):
        batch.coalesce(1).write.mode("append").parquet(src)
        stream_incremental(spark, src, first.schema, str(tmp_path / "c1"), upsert, target=f"{db}.up")
        stream_incremental(spark, src, first.schema, str(tmp_path / "c2"), insert, target=f"{db}.ins")
    want = [(1, "c", 2), (2, "b", 1), (3, None, 1)]
    assert rows(spark.table(f"{db}.up"), "id", "v", "seq") == want
    assert rows(spark.table(f"{db}.ins"), "id", "v", "seq") == want
    # a lost checkpoint reads everything again
    stream_incremental(spark, src, first.schema, str(tmp_path / "c3"), upsert, target=f"{db}.up")
    stream_incremental(spark, src, first.schema, str(tmp_path / "c4"), insert, target=f"{db}.ins")
    assert rows(spark.table(f"{db}.up"), "id", "v", "seq") == want
    assert rows(spark.table(f"{db}.ins"), "id", "v", "seq") == want
    for _ in range(2):  # the second run finds no new file
        final = stream_to_folder(spark, src, first.schema, str(tmp_path / "c5"), str(tmp_path / "t"), "id", order, max_files=1, buckets=2)
        assert rows(final, "id", "seq") == [(1, 2), (2, 1), (3, 1)]


def test_stream_takes_new_columns_and_wider_values(spark, database, tmp_path):
    db, src = database("evolve"), str(tmp_path / "in")
    ddl = "id bigint, v double, extra string"
    schema = frame(spark, ddl, []).schema
    write = insert_writer(f"{db}.t", "id", ["id"], NOW)
    for batch in ([(1, 1.0, None)], [(2, 2.5, "x")]):
        frame(spark, ddl, batch).coalesce(1).write.mode("append").parquet(src)
        stream_incremental(spark, src, schema, str(tmp_path / "c"), write, target=f"{db}.t")
    assert rows(spark.table(f"{db}.t"), "id", "v", "extra") == [(1, 1.0, None), (2, 2.5, "x")]


def test_swap_that_broke_off_is_finished(spark, database):
    db = database("swap")
    first, second = (frame(spark, "id bigint", [(i,)]) for i in (1, 2))
    sinks.replace_table(first, f"{db}.t")
    # killed between the two steps: the old table is dropped, the new one not yet renamed
    second.write.saveAsTable(f"{db}.t__next")
    spark.sql(f"DROP TABLE {db}.t")
    assert sinks.exists(spark, f"{db}.t") and rows(spark.table(f"{db}.t"), "id") == [(2,)]
    # killed before the first step: the old table counts, and the left copy is replaced
    first.write.saveAsTable(f"{db}.t__next")
    sinks.replace_table(spark.table(f"{db}.t").selectExpr("id + 10 AS id"), f"{db}.t")
    assert rows(spark.table(f"{db}.t"), "id") == [(12,)] and not spark.catalog.tableExists(f"{db}.t__next")


def test_values_beyond_bigint_stay_double(spark):
    df = frame(spark, "a double, b double", [(1e20, 1.0), (2.0, None)])
    assert [t for _, t in cleaning.whole_floats_to_int(df).dtypes] == ["double", "bigint"]


def test_jdbc_reads_by_key_ranges(spark):
    source = tables.Source(spark, "jdbc:x", "jdbc", {"user": "u"}, {"tbl_orders": ("id", 1, 900, 8)})
    options = source.jdbc_options("tbl_orders")
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "1", "900", "8")
    assert options["fetchsize"] == "50000" and "partitionColumn" not in source.jdbc_options("tblclients")


def test_null_rate_levels(spark):
    df = frame(spark, "a bigint, b bigint, c bigint", [(None if i < 2 else 1, None if i < 2 else 1, None) for i in range(100)])
    limits = [("t", "a", 5.0, None), ("t", "b", 1.0, 1.5), ("t", "c", 1.0, 1.5)]
    out = quality.null_rates(df, "t", limits)
    assert rows(out, "subject", "status", "observed") == [("t.a", "ok", 2.0), ("t.b", "warn", 2.0), ("t.c", "fail", 100.0)]
    assert quality.run_failed(out) and quality.run_failed(out.filter("status = 'warn'"), strict=True)
    assert not quality.run_failed(out.filter("status = 'warn'"))


def test_freshness(spark):
    marks = frame(spark, "table_name string, last_loaded_at string", [("date", "2024-04-30"), ("ts", "2024-04-29 10:00:00"), ("old", "2024-04-28"), ("id", "725264"), ("none", None)])
    got = {r["subject"]: r["status"] for r in quality.freshness(marks, date(2024, 5, 1)).collect()}
    assert got == {"date": "ok", "ts": "ok", "old": "warn", "id": "ok", "none": "warn"}


@pytest.mark.parametrize("values, status", [([1, 2, None, None], "ok"), ([1, 1], "fail")])
def test_unique_ignores_nulls(spark, values, status):
    df = frame(spark, "v bigint", [(v,) for v in values])
    assert quality.unique(df, "t", "v").first()["status"] == status


def test_declared_lists_are_whole():
    both = [*quality_queries.CORE_DECLARED.values(), *quality_queries.MART_DECLARED.values()]
    assert sum(len(x[1].split()) for x in both) == 56 and sum(len(x[2].split()) for x in both) == 27
    rules = [quality_queries._rules(t, quality_queries.CORE_DECLARED) for t in quality_queries.CORE_DECLARED]
    assert sum(len(x.null_rates) for x in rules) == 12 and sum(x.least is not None for x in rules) == 19


@pytest.mark.parametrize("unique", [(), ("a",), ("a", "b"), ("b", "d", "a")])
def test_fused_checks_equal_single_ones(spark, unique):
    data = [(1, "x", None, date(2024, 1, 1)), (1, "y", 2.0, None), (None, "y", 2.0, date(2024, 1, 1)), (None, None, None, None), (3, "z", None, date(2024, 1, 2))]
    df = frame(spark, "a bigint, b string, c double, d date", data)
    rules = quality.Rules(("a", "b", "c"), unique, 6, 5, (("c", 50.0, None), ("c", 10.0, 50.0)))
    for part in (df, df.limit(0)):
        got = quality.table_checks(part, "t", rules)
        single = quality.not_null(part, "t", ["a", "b", "c"])
        for c in unique:
            single = single.union(quality.unique(part, "t", c))
        single = single.union(quality.min_rows(part, "t", 6))
        assert rows(got.filter("check_name not in ('mart_volume', 'null_rate')")) == rows(single)
    rates = rows(quality.table_checks(df, "t", rules).filter("check_name in ('mart_volume', 'null_rate')"), "check_name", "status", "observed")
    assert rates == [("mart_volume", "ok", 5.0), ("null_rate", "fail", 60.0), ("null_rate", "warn", 60.0)]


def test_fused_checks_read_a_table_once(spark, tmp_path):
    frame(spark, "a bigint, b string", [(1, "x"), (1, None)]).write.parquet(str(tmp_path / "t"))
    out = quality.table_checks(spark.read.parquet(str(tmp_path / "t")), "t", quality.Rules(("a", "b"), ("a", "b"), 1, None, (("b", 1.0, None),)))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and out.count() == 6
