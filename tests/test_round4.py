"""Queries on tables that the provided ones do not cover: long numbers, many rows of a block, shapes of plans."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tenderspark.operators import matching as M
from tenderspark.plans import registry

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, folder, name, *tables):
    """The query's rows over ``folder`` are those of its SQL."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    columns, rows = want.columns, want.fetchall()
    got = registry.queries()[name](spark, str(folder)).select(*[f"`{c}`" for c in columns]).collect()
    assert rows and sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_documents_with_numbers_of_more_than_six_digits(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT * REPLACE (o_orderkey + 9999000 AS o_orderkey) FROM '{SF}/orders.parquet') TO '{tmp_path}/orders.parquet'")
    same_as_sql(spark, tmp_path, "clean_documents", "orders")


def test_the_second_cut_has_every_pair_of_a_block(spark, tmp_path):
    duckdb.sql(f"COPY (SELECT * REPLACE (0 AS label) FROM '{SF}/embeddings.parquet') TO '{tmp_path}/embeddings.parquet'")
    codes, items = duckdb.sql(f"SELECT count(*) FILTER (vec_id % 10 = 0), count(*) FILTER (vec_id % 10 <> 0) FROM '{tmp_path}/embeddings.parquet'").fetchall()[0]
    assert items > 40 and registry.queries()["refilter_topk"](spark, str(tmp_path)).count() == codes * items
    same_as_sql(spark, tmp_path, "refilter_topk", "embeddings")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_row_of_an_item_is_dealt_by_its_block_alone(spark):
    items = spark.range(300).selectExpr("'b' as block", "id as item", "array('w', concat('w', id % 7)) as tokens")
    asked = spark.range(5).selectExpr("'b' as block", "id as code", "array('w', 'w1') as tokens")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = M.bm25_scores(asked, items, "block", "code", "item", "tokens")
        norm = M.minmax_in_block(scores, asked, items, "block", "code", "item", "bm25")
        best = M.candidate_pairs(asked, items, "block", "code", "item", "tokens", 3, 0.1)
        for df in (scores, norm, best):
            assert "SortMergeJoin [block#" not in "\n".join(x for x in plan(df).split("\n") if "item" in x)
        joins = [x for x in plan(scores).split("\n") if "Join" in x]
        assert joins and sum("BroadcastHashJoin" in x for x in joins) >= 2
        assert any("BroadcastHashJoin" in x for x in plan(norm).split("\n")[:8])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("make", [M.candidate_product, lambda *a: M.cosine_scores(*a, "v")])
def test_pairs_of_one_block_come_from_many_tasks(spark, make):
    """And none is missing: of vectors without length, with nulls and of other sizes too."""
    v = "case id % 50 when 0 then array(0f, 0f) when 1 then null when 2 then array(1f) when 3 then array(1f, null) else array(1f, float(id % 3)) end as {}"
    items, codes = spark.range(5000).selectExpr("0 as block", "id as item", v.format("v")), spark.range(600).selectExpr("0 as block", "id as code", v.format("v"))
    out = make(codes, items, "block", "code", "item")
    assert out.rdd.getNumPartitions() >= 8
    assert out.count() == out.select("code", "item").distinct().count() == 3_000_000
    if "cosine" in out.columns:
        some = codes.where("code < 60").join(items.withColumnRenamed("v", "w"), "block")
        want = some.select("code", "item", M.cosine(F.col("v"), F.col("w")).alias("want"))
        off = out.join(want, ["code", "item"]).where("(cosine is null) != (want is null) or abs(cosine - want) > 1e-12")
        assert out.where("cosine is not null").count() > 2_000_000 and off.count() == 0


def test_the_report_moves_no_row_from_the_ranks_on(spark, tmp_path):
    """And lines whose order, buyer or supplier is missing have a rank but no row, those of one that occurs twice have two rows."""
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "nation": "n_nationkey"}
    for t, key in keys.items():
        twice = f"UNION ALL FROM '{SF}/{t}.parquet' WHERE {key} % 7 = 3" if t in ("customer", "supplier", "orders") else ""
        duckdb.sql(f"COPY (FROM '{SF}/{t}.parquet' WHERE ({key}) % 9 <> 4 OR {t in ('nation', 'part')} {twice}) TO '{tmp_path}/{t}.parquet'")
    duckdb.sql(f"COPY (SELECT * REPLACE (CASE WHEN l_partkey % 10 <> 1 THEN l_orderkey END AS l_orderkey) FROM '{SF}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet'")
    same_as_sql(spark, tmp_path, "report_rows", "lineitem", *keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = plan(registry.queries()["report_rows"](spark, str(tmp_path)))
        lines = [x for x in steps.split("Window [row_number()")[0].split("\n") if "Exchange" in x]
        assert "SortMergeJoin" in steps and "Sort [" not in steps.split("Window [row_number()")[0] and not lines and steps.count("Exchange hashpartitioning") <= 11
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
