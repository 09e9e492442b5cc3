"""Binding of the library's roles to the provided tables, in Spark and in SQL: items, documents, catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.operators.tables import one_per_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def items(spark: SparkSession, sf_dir: str, by_document: bool = False) -> DataFrame:
    """One row per (document, number): the first line in a total order wins. ``by_document`` deals the lines by document alone,
    so that a join on it needs no further shuffle."""
    lines = table(spark, sf_dir, "lineitem")
    lines = one_per_key(lines.repartition("l_orderkey") if by_document else lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return lines.select(
        F.concat_ws("::", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("item_key"),
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_shipdate").alias("shipped"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
    )


ITEMS = """items AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '::' || CAST(l_linenumber AS VARCHAR) AS item_key, l_orderkey AS document, l_linenumber AS number, l_partkey AS code, l_suppkey AS supplier,
         l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price, l_shipdate AS shipped, l_returnflag AS flag, l_linestatus AS status
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) = 1
)"""


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description"), F.col("p_brand").alias("unit"), F.col("p_type").alias("category"))


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with their description (part name), unit (brand) and category (part type)."""
    return items(spark, sf_dir).join(parts(spark, sf_dir), "code")


DESCRIBED = ITEMS + """, described AS (
  SELECT items.*, p_name AS description, p_brand AS unit, p_type AS category FROM items JOIN part ON code = p_partkey
)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue entries: two types by the parity of the key, grouped by part type, named by brand."""
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, "material").otherwise("service").alias("kind"), F.col("p_partkey").cast("string").alias("code"),
        F.col("p_size").cast("string").alias("pdm"), F.col("p_brand").alias("name"), F.col("p_name").alias("description"), F.col("p_type").alias("group_name"), F.col("p_retailprice").alias("price"),
    )


CATALOG = """catalog AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN 'material' ELSE 'service' END AS kind, CAST(p_partkey AS VARCHAR) AS code, CAST(p_size AS VARCHAR) AS pdm, p_brand AS name, p_name AS description, p_type AS group_name, p_retailprice AS price
  FROM part
)"""


def r4(c):
    """Four decimals, with exact ties moved off the edge so that both engines round them alike."""
    x = F.round((F.col(c) if isinstance(c, str) else c) + F.lit(1e-7), 4)
    return F.when(x == 0, F.lit(0.0)).otherwise(x)


def sql4(x: str) -> str:
    r = f"round(({x}) + 1e-7::DOUBLE, 4)"
    return f"CASE WHEN {r} = 0 THEN 0.0::DOUBLE ELSE {r} END"


class Plans:
    """A module's queries and their SQL, filled by ``add``."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return keep
