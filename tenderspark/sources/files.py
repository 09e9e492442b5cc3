"""Sources and sinks: catalogue pages, part files, string CSV, ragged CSV, search hits, page text, reports."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.functions import text as T
from tenderspark.operators.tables import one_per_key

MATERIAL = "codigoItem string, codigoPdm string, nomePdm string, descricaoItem string, codigoGrupo string, nomeGrupo string"
SERVICE = "codigoServico string, nomeServico string, codigoGrupo string, nomeGrupo string"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate files, which the file system deletes when the session ends: under
    ``spark.checkpoint.dir``, which executors share. Where that is unset, as in tests, a run in one process takes the system's
    temp folder; a cluster must name one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext._jsc.sc().isLocal():
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{root.rstrip('/') if root else 'file://' + os.path.join(tempfile.gettempdir(), 'tenderspark')}/{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in a new scratch folder: what several branches of a plan read is made once, and a lost
    executor does not undo it."""
    spark, path = df.sparkSession, scratch(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_catalog_pages(spark: SparkSession, materials: str, services: str) -> DataFrame:
    """(kind, code, pdm, name, description, group_code, group_name) from both record shapes of JSON pages: blanks are
    null, a missing description is empty, records without a key are dropped."""
    b = lambda c: T.blank_to_null(F.col(c))
    m = spark.read.schema(MATERIAL).json(materials).select(F.lit("material").alias("kind"), b("codigoItem").alias("code"), b("codigoPdm").alias("pdm"), b("nomePdm").alias("name"), F.coalesce(b("descricaoItem"), F.lit("")).alias("description"), b("codigoGrupo").alias("group_code"), b("nomeGrupo").alias("group_name"))
    s = spark.read.schema(SERVICE).json(services).select(F.lit("service").alias("kind"), b("codigoServico").alias("code"), F.lit(None).cast("string").alias("pdm"), b("nomeServico").alias("name"), F.coalesce(b("nomeServico"), F.lit("")).alias("description"), b("codigoGrupo").alias("group_code"), b("nomeGrupo").alias("group_name"))
    return m.unionByName(s).where("code is not null")


def compact_page_parts(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """All part files of a folder, the first row of each key in ``order``."""
    return one_per_key(spark.read.parquet(path), keys, order)


def string_schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def read_string_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, every column a string, quoted line breaks kept, an optional byte-order mark ignored."""
    return spark.read.schema(string_schema(columns)).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def repair_ragged_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """The rows of a CSV brought to ``columns``: short ones padded with nulls, long ones cut; ``row_kind`` says which, by the
    number of fields: commas outside quotes and one."""
    schema = string_schema([*columns, "_raw"])
    df = spark.read.schema(schema).option("header", header).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").csv(path)
    bare = F.regexp_replace("_raw", r'"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    kind = F.when(fields < len(columns), "padded").when(fields > len(columns), "cut").otherwise("whole")
    return df.select(*columns, kind.alias("row_kind"))


HIT = "control string, kind string, year string, seq string, act_seq string, uf string, uf_unit string, updated string, published string, items array<struct<number:int,code:long,supplier:long,quantity:double,price:double,estimate:double,status:string>>"


#: A landed hit, with the search that brought it.
FOUND = f"{HIT}, term string, source string"


def read_search_hits(spark: SparkSession, path: str) -> DataFrame:
    """Documents of landed search results: the sequence comes from the contract's or the act's field, the state and the
    date have fallbacks; records without a control number are dropped."""
    return identified(spark.read.schema(HIT).json(path))


def identified(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a document from a raw search hit, of a batch or of a stream; those of ``keep`` stay."""
    b = lambda c: T.blank_to_null(F.col(c))
    return raw.where(b("control").isNotNull()).select(
        b("control").alias("control"),
        b("kind").alias("kind"),
        b("year").try_cast("int").alias("year"),
        F.when(F.col("kind") == "act", b("act_seq")).otherwise(b("seq")).try_cast("long").alias("seq"),
        F.coalesce(b("uf"), b("uf_unit")).alias("uf"),
        T.parse_timestamp(F.coalesce(b("updated"), b("published"))).alias("updated_at"),
        "items",
        *keep,
    )


def stream_search_hits(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Documents of search results that land under ``path`` as JSON, with their ``term`` and ``source``, as a stream."""
    reader = spark.readStream.schema(FOUND).option("recursiveFileLookup", True)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return identified(reader.json(path), ("term", "source"))


def explode_document_items(documents: DataFrame) -> DataFrame:
    """One row per approved item of a document; the winner's price if it is there and not zero, else the estimate."""
    rows = documents.select("control", "kind", "uf", "updated_at", F.explode("items").alias("i")).where(F.trim("i.status") == "O")
    good = F.coalesce(F.col("i.price") != 0, F.lit(False))
    return rows.select(T.item_key(F.col("control"), F.col("i.number")).alias("item_key"), "control", "kind", "uf", "updated_at", F.col("i.code").alias("code"), F.when(good, F.col("i.supplier")).alias("supplier"), F.col("i.quantity").alias("quantity"), F.when(good, F.col("i.price")).otherwise(F.col("i.estimate")).alias("unit_price"))


def write_pages(pages: DataFrame, path: str, keys: list[str], order: list) -> None:
    """Page text, one row per key (the first in ``order``), NUL characters removed, with its length."""
    clean = pages.withColumn("text", T.strip_nul(F.col("text")))
    one_per_key(clean, keys, order).withColumn("n_chars", F.length("text")).write.parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report_csv(report: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV report with a fixed column order, every field quoted."""
    report.select(*columns).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def flatten_to_star(flat: DataFrame, document: str, doc_cols: list[str], item_cols: list[str], terms: str, order: list) -> dict[str, DataFrame]:
    """Documents (the first row wins, with the number of items), document x term, and items of a flat file."""
    docs = flat.groupBy(document).agg(F.min_by(F.struct(*doc_cols), F.struct(*order)).alias("_d"), F.count(F.lit(1)).alias("n_items")).select(document, "_d.*", "n_items")
    links = flat.select(document, F.explode(T.split_pipe(F.col(terms))).alias("term")).distinct()
    return {"document": docs, "document_term": links, "item": flat.select(document, *item_cols)}


def pivot_pair_sources(scored: DataFrame, candidates: DataFrame, verdicts: DataFrame, codes: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of the scored table with candidate scores and verdicts beside them; ``dropped`` names an unknown side."""
    out = scored.join(candidates, ["code", "item_key"], "left").join(verdicts, ["code", "item_key"], "left")
    out = out.join(codes.select("code").distinct().withColumn("_c", F.lit(True)), "code", "left").join(items.select("item_key").distinct().withColumn("_i", F.lit(True)), "item_key", "left")
    return out.withColumn("dropped", F.when(F.col("_c").isNull(), "unknown_code").when(F.col("_i").isNull(), "unknown_item")).drop("_c", "_i")
