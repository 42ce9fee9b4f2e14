import datetime as dt

import pytest

from saldoflow.plans.job import target_location
from saldoflow.sources.binding import SourceBinding, SourceTable, literal_row, parse_source_list, read_query_texts, run_views


def test_source_list():
    tables = parse_source_list(" stg.a , dwh.b.c ")
    assert tables == [SourceTable("stg", "a"), SourceTable("dwh", "b.c")]
    assert tables[0].alias == "a" and tables[0].full_name("cat") == "cat.stg.a"


@pytest.mark.parametrize("blank", [None, "", "  ", " , "])
def test_blank_list(blank):
    assert parse_source_list(blank) == []


def test_items_without_a_dot():
    with pytest.raises(ValueError, match="'suelta'"):
        parse_source_list("stg.a,suelta")
    assert parse_source_list("stg.a,suelta", strict=False) == [SourceTable("stg", "a")]


def test_binding(spark):
    spark.range(3).write.saveAsTable("default.bound_numbers")
    binding = SourceBinding(parse_source_list("default.bound_numbers"), catalog="spark_catalog")
    assert binding.name("bound_numbers") == "spark_catalog.default.bound_numbers"
    assert binding.read(spark, "bound_numbers").count() == 3
    with pytest.raises(ValueError, match=r"'x'.*bound_numbers"):
        binding.name("x")
    spark.sql("DROP TABLE default.bound_numbers")


def test_literal_row(spark):
    row = literal_row(spark, id=1, texto="x", fecha_corte=dt.date(2025, 11, 7)).first()
    assert tuple(row) == (1, "x", dt.date(2025, 11, 7))


def test_views_run_in_order_with_parameters(spark):
    views = [("v_uno", "SELECT id, :n AS n FROM range(5)"), ("v_dos", "SELECT sum(id) AS s, max(n) AS n FROM v_uno")]
    df = run_views(spark, views, "SELECT s + n AS total FROM IDENTIFIER(:dos)", args={"n": 7, "dos": "v_dos"}, keep=False)
    assert not spark.catalog.tableExists("v_uno")
    assert df.first()["total"] == 17


def test_kept_views_stay(spark):
    run_views(spark, [("v_tres", "SELECT 1 AS x")], "SELECT * FROM v_tres")
    assert spark.catalog.tableExists("v_tres")
    spark.catalog.dropTempView("v_tres")


def test_query_texts_from_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.sql").write_text("SELECT 'ñ'\nFROM x.y", encoding="utf-8")
    (tmp_path / "sub" / "b.sql").write_text("SELECT 2", encoding="utf-8")
    (tmp_path / "c.txt").write_text("no")
    rows = {r["query_id"].rsplit("/", 1)[1]: r["sql_text"] for r in read_query_texts(spark, str(tmp_path)).collect()}
    assert rows == {"a.sql": "SELECT 'ñ'\nFROM x.y", "b.sql": "SELECT 2"}


def test_location():
    assert target_location("bucket", "/folder/", "tabla") == "s3://bucket/folder/tabla"
