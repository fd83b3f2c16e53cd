"""The library's operators applied to the test tables, each with its SQL.

Every query reads whole tables and goes through the same functions as the
health datasets do.
"""

from __future__ import annotations

import datetime as dt
import io
import json
import uuid
import zipfile
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.functions.columns import dated_url, named, parse_date, route
from epilake.layout import Batch, LakeLayout
from epilake.operators.aggregate import (
    distinct_dim,
    one_outcome,
    outcome_count,
    outcome_counts,
    zero_count,
    zero_count_sql,
)
from epilake.operators.filters import drop_placeholder, keep_any_known
from epilake.operators.latest import latest_per_key
from epilake.operators.rename import rename_strict, sort_desc
from epilake.operators.stamp import parse_date_column, stamp
from epilake.plans.daily import DATE_PATTERNS
from epilake.plans.jobs import LOADS, JobError, export, export_loads, run_all, run_daily, run_monthly
from epilake.plans.landing import land
from epilake.session import scratch_path
from epilake.sinks.files import read_curated, write_batch, write_curated, write_rows
from epilake.sinks.jdbc import JdbcTarget, append_once, missing_rows, overwrite_table, read_table
from epilake.sinks.ledger import Ledger
from epilake.sinks.pointers import record_header, write_pointer
from epilake.sources.archive import archive_members, inflate, parse_lines, read_zipped_delimited
from epilake.sources.catalog import CATALOG_SCHEMA, in_period, landing_plan, read_catalog
from epilake.sources.control import latest_batches, latest_pointers, parse_pointer
from epilake.sources.delimited import MALFORMED, read_delimited
from epilake.sources.dialect import STAGED, CsvDialect
from epilake.sources.headers import Header
from epilake.sources.registry import (
    BEDS,
    CASES,
    CONDITIONS,
    INDIGENOUS,
    INPATIENTS,
    MICRODATA,
    PROFESSIONALS,
    RANKING,
    TESTS,
    VACCINES,
    DatasetSpec,
    apply_types,
    read_batch,
    read_landed,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_DATE = dt.date(2022, 11, 3)
NEXT_DATE = dt.date(2022, 11, 4)


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Filters


@query(
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"
    " WHERE o_orderpriority <> '4-NOT SPECIFIED'"
)
def filter_not_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    known = drop_placeholder(orders, "o_orderpriority", "4-NOT SPECIFIED")
    return known.select("o_orderkey", "o_custkey", "o_orderpriority")


@query(
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, 'true' AS condition"
    " FROM lineitem"
    " WHERE NOT coalesce(nullif(l_returnflag, 'A') = 'N' AND l_linestatus = 'O', false)"
)
def any_known_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    unknown = F.lit("IGNORADO")
    flags = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
        .withColumn("devolvido", F.when(flag == "N", unknown).when(flag != "A", flag))
        .withColumn("situacao", F.when(status == "O", unknown).otherwise(status))
    )
    return keep_any_known(flags, ["devolvido", "situacao"], "IGNORADO").drop("devolvido", "situacao")


# Projections


@query(
    'SELECT p_partkey, p_name AS "Nome", p_brand, p_type, p_retailprice AS "Preco" FROM part'
)
def rename_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return rename_strict(part, {"p_name": "Nome", "p_retailprice": "Preco"}).drop("p_size")


@query("SELECT s_suppkey, s_name, s_acctbal AS saldo FROM supplier ORDER BY s_acctbal DESC")
def rename_sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = rename_strict(table(spark, sf_dir, "supplier"), {"s_acctbal": "saldo"})
    return sort_desc(renamed.drop("s_nationkey"), "saldo")


@query("SELECT *, DATE '2022-11-03' AS data_execucao FROM customer")
def audit_run_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(table(spark, sf_dir, "customer"), "data_execucao", RUN_DATE)


# Aggregates and the latest row


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_code_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_dim(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


_ZERO = (
    "SELECT l_suppkey, COUNT(l_discount) AS zero_discount_lines FROM lineitem"
    " WHERE l_discount = 0 GROUP BY l_suppkey"
)


@query(_ZERO)
def zero_measure_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return zero_count(lines, ["l_suppkey"], "l_discount", "zero_discount_lines")


@query(_ZERO)
def zero_measure_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return zero_count_sql(lines, ["l_suppkey"], "l_discount", "zero_discount_lines")


@query(
    "SELECT user_id, event_id, event_type, value FROM events"
    " QUALIFY row_number() OVER"
    " (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"
)
def latest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"]).drop("ts")


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        F.month("o_orderdate").alias("mes"),
        (F.col("o_orderstatus") == "F").alias("fechado"),
    )


_OUTCOME_KEYS = ["o_orderpriority", "mes"]


@query(
    "SELECT o_orderpriority, month(o_orderdate)::INT AS mes, COUNT(*) AS \"Total\" FROM orders"
    " WHERE (o_orderstatus = 'F') = true GROUP BY ALL"
)
def outcome_true_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_count(_outcomes(spark, sf_dir), "fechado", True, _OUTCOME_KEYS, "Total", "mes")


@query(
    "SELECT o_orderpriority, month(o_orderdate)::INT AS mes, COUNT(*) AS \"Total\" FROM orders"
    " WHERE (o_orderstatus = 'F') = false GROUP BY ALL"
)
def outcome_false_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_count(_outcomes(spark, sf_dir), "fechado", False, _OUTCOME_KEYS, "Total", "mes")


@query(
    "SELECT o_orderpriority, month(o_orderdate)::INT AS mes,"
    " COUNT(*) FILTER (o_orderstatus = 'F') AS fechados,"
    " COUNT(*) FILTER (o_orderstatus <> 'F') AS abertos"
    " FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY ALL"
)
def outcome_counts_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(_outcomes(spark, sf_dir), "fechado", _OUTCOME_KEYS, "fechados", "abertos")


@query(
    "SELECT l_suppkey, COUNT(*) AS obitos FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey"
)
def outcome_from_text_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    stated = F.when(flag == "R", "TRUE").when(flag == "A", "0").otherwise("sem dado")
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", stated.alias("obito"))
    counts = outcome_counts(lines, "obito", ["l_suppkey"], "obitos", "curados")
    return one_outcome(counts, ["l_suppkey"], "obitos", "l_suppkey")


# Scalar functions


@query(
    "SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 10 = 0 THEN 'sem data'"
    " ELSE strftime(o_orderdate, '%d/%m/%Y') END, '%d/%m/%Y') AS DATE) AS \"Data_Coleta\""
    " FROM orders"
)
def parse_br_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("o_orderkey") % 10 == 0, "sem data").otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    texts = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("Data_Coleta"))
    return parse_date_column(texts, "Data_Coleta", "dd/MM/yyyy")


@query(
    "SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS datahora"
    " FROM events"
)
def parse_iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", F.date_format("ts", "yyyyMMdd"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    texts = table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    return texts.select("event_id", parse_date(F.col("written"), *DATE_PATTERNS).alias("datahora"))


@query(
    "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS obito,"
    " CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linenumber = 2 THEN 3000000000 + CAST(l_quantity AS BIGINT)"
    " ELSE CAST(l_quantity AS BIGINT) END AS quantidade FROM lineitem"
)
def cast_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files have them: ``7``, ``7.0``, a number beyond 32 bits, and two that are not whole."""
    flag, line, amount = F.col("l_returnflag"), F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    text = amount.cast("string")
    written = (
        F.when((flag == "N") & (line == 1), F.concat(text, F.lit(".234")))
        .when(flag == "N", F.concat(text, F.lit(",5")))
        .when(line == 2, (amount + 3_000_000_000).cast("string"))
        .when(line == 3, F.concat(text, F.lit(".0")))
        .otherwise(text)
    )
    texts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "R", "True").when(flag == "N", "0").otherwise("?").alias("obito"),
        written.alias("quantidade"),
    )
    return apply_types(texts, {"obito": "boolean", "quantidade": "bigint"})


# Control files and the catalogue


@query(
    "SELECT event_type, split_part(m, '|', 1) AS process_date, split_part(m, '|', 2) AS uuid"
    " FROM (SELECT event_type, max(strftime(ts, '%Y%m%d') || '|' || event_id::VARCHAR) AS m"
    " FROM events GROUP BY 1)"
)
def control_file_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat_ws("|", F.date_format("ts", "yyyyMMdd"), F.col("event_id").cast("string"))
    lines = table(spark, sf_dir, "events").select("event_type", line.alias("line"))
    pointers = lines.select("event_type", parse_pointer(F.col("line")).alias("pointer"))
    return latest_pointers(pointers.select("event_type", "pointer.*"), "event_type")


@query(
    "SELECT event_id, 'base/' || strftime(ts, '%Y') || '/' || strftime(ts, '%m') || '/'"
    " || strftime(ts, '%Y%m%d') || '_' || event_type || '_'"
    " || json_extract_string(props, '$.k') || '.csv' AS url"
    " FROM events WHERE contains(event_type, 'i')"
)
def catalog_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    item = F.from_json("props", "k STRING").getField("k")
    source = F.concat("event_type", F.lit("_"), item)
    due = in_period(F.col("event_type"), events.schema["event_type"].dataType, "i")
    url = dated_url(F.lit("base/"), source, F.lit("csv"), F.col("ts"))
    return events.filter(due).select("event_id", url.alias("url"))


@query(
    "SELECT route, count(*) AS count FROM"
    " (SELECT CASE event_type WHEN 'error' THEN 'zip' WHEN 'signup' THEN 'csv' END AS route"
    " FROM events) WHERE route IS NOT NULL GROUP BY 1"
)
def catalog_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = route(F.col("event_type"), {"error": "zip", "signup": "csv"})
    routed = table(spark, sf_dir, "events").select(target.alias("route"))
    return routed.filter(F.col("route").isNotNull()).groupBy("route").count()


@query(
    "SELECT 'u' || user_id AS dataset, route,"
    " CASE route WHEN 'csv' THEN 'b/2022/11/20221103_' || event_id || '.csv'"
    " ELSE 'b/' || event_id || '.zip' END AS url,"
    " '20221103' AS process_date, 'r1' AS uuid"
    " FROM (SELECT *, CASE event_type WHEN 'error' THEN 'zip' WHEN 'signup' THEN 'csv' END"
    " AS route FROM events) WHERE route IS NOT NULL AND value > 50"
)
def catalog_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = route(F.col("event_type"), {"error": "zip", "signup": "csv"})
    catalog = table(spark, sf_dir, "events").select(
        F.lit("b/").alias("base"),
        F.col("event_id").cast("string").alias("source"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("dataset"),
        F.coalesce(kind, F.lit("xls")).alias("type"),
        F.when(F.col("value") > 50, "diaria").otherwise("mensal").alias("Atualizacao"),
    )
    return landing_plan(catalog, "diaria", RUN_DATE, "r1")


# Files


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_roundtrip")
    write_rows(table(spark, sf_dir, "orders"), path, "csv", STAGED)
    rows = apply_types(
        read_delimited(spark, path, STAGED), {"o_orderkey": "bigint", "o_totalprice": "double"}
    )
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "SELECT doc_id, unnest(string_split(text, chr(10))) AS line,"
    " generate_subscripts(string_split(text, chr(10)), 1)::INT - 1 AS line_no FROM documents"
)
def transcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte of the texts as one character of an ISO-8859-1 file, and back."""
    latin = STAGED.with_(encoding="ISO-8859-1")
    path = scratch_path(spark, "transcode")
    lines = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    texts = table(spark, sf_dir, "documents").select("doc_id", lines)
    texts = texts.withColumn("line", F.decode(F.encode("line", "UTF-8"), "ISO-8859-1"))
    write_rows(texts, path, "csv", latin)
    rows = apply_types(read_delimited(spark, path, latin), {"doc_id": "bigint", "line_no": "int"})
    line = F.decode(F.encode(F.coalesce("line", F.lit("")), "ISO-8859-1"), "UTF-8")
    return rows.withColumn("line", line)


def _publish_zips(rows: DataFrame, root: str) -> None:
    """Zip files of two members in folders below ``root``, one file for each Arrow batch of each task."""
    header = STAGED.sep.join(rows.columns)

    def pack(batches):
        task = TaskContext.get().partitionId()
        files, base = FileSystem.from_uri(root)
        for number, batch in enumerate(batches):
            lines = batch.column(0).to_pylist()
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
                for member, part in (("a", lines[::2]), ("b", lines[1::2])):
                    archive.writestr(f"pasta/{member}.csv", "\n".join([header, *part]))
            folder = f"{base}/{task % 3}"
            files.create_dir(folder, recursive=True)
            # A task that runs again writes the same file under the same name.
            with files.open_output_stream(f"{folder}/{task}-{number}.zip") as out:
                out.write(content.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([len(lines)])], names=["lines"])

    line = F.to_csv(F.struct(*rows.columns), STAGED.record_options())
    rows.select(line).mapInArrow(pack, "lines BIGINT").write.format("noop").mode("overwrite").save()


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def zip_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip files of two members in a tree of folders, listed and read as landing does."""
    root = scratch_path(spark, "zip_landing")
    _publish_zips(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), root)
    rows = read_zipped_delimited(spark, root, STAGED, recursive=True)
    return apply_types(rows, {"o_orderkey": "bigint", "o_totalprice": "double"})


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def zip_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members, then lines, then records, step by step."""
    root = scratch_path(spark, "zip_expand")
    _publish_zips(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), root)
    members = archive_members(spark, root, recursive=True)
    rows = parse_lines(inflate(members, STAGED), ["o_orderkey", "o_orderpriority"], STAGED)
    return apply_types(rows, {"o_orderkey": "bigint"})


@query("SELECT p_brand, p_partkey, p_size FROM part WHERE p_size > 25")
def batch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land two batches as text; the pointer says which is read, whatever the ids."""
    root = scratch_path(spark, "batch_roundtrip")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated", raw_format="csv")
    spec = DatasetSpec("part", {"p_brand": "string", "p_partkey": "bigint", "p_size": "int"})
    part = table(spark, sf_dir, "part").select(*spec.columns)
    for batch, kept in ((Batch("part", "20221103", "b"), "p_size <= 25"), (Batch("part", "20221103", "a"), "p_size > 25")):
        write_batch(part.filter(kept), layout, batch)
        write_pointer(spark, layout, batch)
    return read_batch(spark, layout, spec, latest_batches(spark, layout, ["part"])["part"])


@query(
    "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')"
)
def land_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON catalogue with a text file and zip files of one dataset, landed and read by its pointer."""
    root = scratch_path(spark, "land_catalog")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated")
    spec = DatasetSpec(
        "pedidos", {"o_orderkey": "bigint", "o_orderpriority": "string", "o_totalprice": "double"}, STAGED
    )
    orders = table(spark, sf_dir, "orders")
    dated = f"{root}/site/{RUN_DATE:%Y/%m/%Y%m%d}_aberto.csv"
    write_rows(orders.filter("o_orderstatus = 'O'").select(*spec.columns), dated, "csv", STAGED)
    _publish_zips(orders.filter("o_orderstatus = 'F'").select(*spec.columns), f"{root}/site/fechado.zip")
    keys = ("base", "source", "dataset", "type", "Atualizacao")
    entries = [
        (f"{root}/site/", "aberto", "pedidos", "csv", "diaria"),
        (f"{root}/site/", "aberto", "pedidos", "csv", "diaria"),
        (f"{root}/site/", "fechado", "pedidos", "zip", "diaria"),
        (f"{root}/site/", "outro", "pedidos", "xls", "diaria"),
        (f"{root}/site/", "velho", "pedidos", "csv", "mensal"),
    ]
    listed = json.dumps([dict(zip(keys, entry, strict=True)) for entry in entries])
    spark.createDataFrame([(listed,)], "value STRING").coalesce(1).write.text(f"{root}/catalogo.json")
    catalog = read_catalog(spark, f"{root}/catalogo.json")
    [batch] = land(spark, layout, catalog, "diaria", RUN_DATE, specs={spec.name: spec}, recursive=True)
    assert latest_batches(spark, layout, [spec.name])[spec.name] == batch
    return read_batch(spark, layout, spec, batch)


@query(
    "SELECT event_id, CASE WHEN event_type <> 'signup' THEN event_type END AS event_type,"
    " CASE event_type WHEN 'error' THEN event_id || ';error;' || user_id WHEN 'signup' THEN event_id::VARCHAR END"
    " AS malformado FROM events"
)
def land_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a field too many or too few: their whole text is landed, and counted."""
    root = scratch_path(spark, "land_malformed")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated")
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    line = (
        F.when(kind == "error", F.concat_ws(";", key, kind, F.col("user_id").cast("string")))
        .when(kind == "signup", key)
        .otherwise(F.concat_ws(";", key, kind))
    )
    raw = CsvDialect(sep="\x01", quote="\0")  # lines are written as they are, under a header
    texts = table(spark, sf_dir, "events").select(line.alias("event_id;event_type"))
    write_rows(texts, f"{root}/site/2022/11/20221103_eventos.csv", "csv", raw)
    catalog = spark.createDataFrame([(f"{root}/site/", "eventos", "eventos", "csv", "diaria")], CATALOG_SCHEMA)
    [batch] = land(spark, layout, catalog, "diaria", RUN_DATE)
    rows = read_landed(spark, layout, batch).withColumnRenamed(MALFORMED, "malformado")
    assert batch.malformed > 0
    return apply_types(rows, {"event_id": "bigint"}).select("event_id", "event_type", "malformado")


@query(
    "SELECT o_orderkey, o_orderstatus,"
    " CASE o_orderstatus WHEN 'P' THEN '20221103' ELSE '20221104' END AS process_date"
    " FROM orders WHERE o_orderstatus IN ('P', 'O')"
)
def curated_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two dates, write the first again: only its rows are replaced."""
    root = scratch_path(spark, "curated_overwrite")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status, date in (("F", "20221103"), ("O", "20221104"), ("P", "20221103")):
        write_curated(orders.filter(F.col("o_orderstatus") == status), layout, "pedidos", date)
    return read_curated(spark, layout, "pedidos")


@query(
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_custkey::VARCHAR ELSE 'C' || o_custkey END AS cliente,"
    " CASE o_orderstatus WHEN 'O' THEN o_orderpriority END AS prioridade,"
    " (o_orderkey % 7)::DOUBLE AS resto,"
    " CASE o_orderstatus WHEN 'F' THEN (9007199254740993 + o_orderkey)::VARCHAR ELSE (o_orderkey % 1000 + 0.5)::VARCHAR END AS grande,"
    " CASE o_orderstatus WHEN 'F' THEN (o_custkey::BIGINT * 1000000007)::DECIMAL(25, 4)::VARCHAR"
    " ELSE (o_custkey % 90000 + 0.0625)::DECIMAL(25, 4)::VARCHAR END AS valor,"
    " CASE o_orderstatus WHEN 'F' THEN '20221103' ELSE '20221104' END AS process_date"
    " FROM orders WHERE o_orderstatus IN ('F', 'O')"
)
def curated_all_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second date has one column more and four of other types; all dates are read as one table, every value exact.

    ``grande`` is whole numbers beyond what a double holds on one date and doubles on the other, so its type is text;
    ``valor`` is whole numbers on one date and decimals on the other, so its type is a decimal with room for both.
    """
    root = scratch_path(spark, "curated_all_dates")
    layout = LakeLayout(f"{root}/raw", f"{root}/curated")
    orders = table(spark, sf_dir, "orders")
    key, rest = F.col("o_orderkey"), F.col("o_orderkey") % 7
    first = orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey",
        F.col("o_custkey").alias("cliente"),
        rest.cast("int").alias("resto"),
        (F.lit(9007199254740993) + key).alias("grande"),
        (F.col("o_custkey").cast("bigint") * 1000000007).alias("valor"),
    )
    second = orders.filter("o_orderstatus = 'O'").select(
        "o_orderkey",
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("cliente"),
        F.col("o_orderpriority").alias("prioridade"),
        rest.cast("double").alias("resto"),
        (key % 1000 + 0.5).cast("double").alias("grande"),
        (F.col("o_custkey") % 90000 + 0.0625).cast("decimal(10,4)").alias("valor"),
    )
    for rows, date in ((first, RUN_DATE), (second, NEXT_DATE)):
        write_curated(rows, layout, "pedidos", f"{date:%Y%m%d}")
    found = read_curated(spark, layout, "pedidos")
    return found.withColumn("valor", F.col("valor").cast("string"))



# Whole jobs on batches made from the tables


def _lake(spark: SparkSession, label: str) -> LakeLayout:
    root = scratch_path(spark, label)
    return LakeLayout(f"{root}/raw", f"{root}/curated")


def _land_in(layout: LakeLayout, spec: DatasetSpec, rows: DataFrame, batch_id: str = "r1", date: dt.date = RUN_DATE) -> Batch:
    """Land a frame as a batch of text, with its header, and make it the current one."""
    spark, batch = rows.sparkSession, Batch(spec.name, f"{date:%Y%m%d}", batch_id)
    text = rows.select(*[named(name).cast("string").alias(name) for name in rows.columns])
    write_batch(text, layout, batch)
    drift = record_header(spark, layout, batch, Header(tuple(rows.dtypes)))
    write_pointer(spark, layout, batch)
    return replace(batch, drift=drift)


def _land(spark: SparkSession, label: str, spec: DatasetSpec, rows: DataFrame) -> LakeLayout:
    layout = _lake(spark, label)
    _land_in(layout, spec, rows)
    return layout


# The health datasets as the test tables can fill them


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("F"), F.col("l_suppkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "Ignorado").otherwise(name).alias("nome_munic"),
        F.col("l_suppkey").alias("codigo_ibge"),
        (F.col("l_linenumber") - 1).alias("casos_novos"),
    )


def _patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("nome_munic"),
        F.month("o_orderdate").alias("nome_drs"),
        (F.col("o_custkey") % 100).alias("idade"),
        F.lit(None).cast("string").alias("raca_cor"),
        F.lit("M").alias("cs_sexo"),
        F.lit("CONFIRMADO").alias("diagnostico_covid19"),
        F.when(status == "F", "True").when(status == "O", "0").alias("obito"),
    )


def _beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    written = (
        F.when(kind == "error", "ontem")
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf_dir, "events").select(
        written.alias("datahora"), F.col("user_id").alias("nome_drs"), F.col("event_id").alias("evento")
    )


def _ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["c_name", "c_custkey", F.concat("c_nationkey", F.lit(".0")), F.col("c_custkey") * 100_000, "c_mktsegment"]
    rows = table(spark, sf_dir, "customer").select(values + [F.lit("7").alias("total")])
    return rows.toDF(*RANKING.columns, "Grand Total")


def _vaccines(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_orderkey", F.col("l_orderkey") + 1,
              F.lit("1,5"), "l_partkey"]
    rows = table(spark, sf_dir, "lineitem").select([F.date_format("l_shipdate", "yyyy-MM-dd")] + values)
    return rows.toDF(*VACCINES.columns)


def _microdata(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown, returned = F.lit("IGNORADO"), F.col("l_returnflag") == "A"
    flags = [unknown] * 11 + [F.when(F.col("l_quantity") > 40, "SIM").otherwise(unknown), F.when(~returned, unknown)]
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    return table(spark, sf_dir, "lineitem").select(key, *flags).toDF("id", *CONDITIONS)


def _professionals(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("p_size") != 7, F.col("p_size"))
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", size)
    return rows.toDF("Código CBO", "Ocupação", "Número de casos confirmados COVID-19")


def _indigenous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_name", "s_nationkey").toDF(*INDIGENOUS.columns)


def _tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    written = F.when(F.col("o_orderkey") % 10 == 0, F.date_format("o_orderdate", "d MMM")).otherwise(day)
    return table(spark, sf_dir, "orders").select(written, "o_orderpriority", "o_custkey").toDF(*TESTS.columns)


@query(
    "SELECT 'F' || l_suppkey AS nome_munic, COUNT(*) AS dias_sem_casos_novos FROM lineitem"
    " WHERE l_returnflag <> 'A' AND l_linenumber = 1 GROUP BY 1"
)
def daily_cases_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, "daily_cases_job", CASES, _cases(spark, sf_dir), "sem_casos_novos")


@query(
    "SELECT o_orderpriority AS nome_munic, month(o_orderdate)::VARCHAR AS nome_drs,"
    " (o_custkey % 100)::BIGINT AS idade, NULL::VARCHAR AS raca_cor, 'M' AS cs_sexo,"
    " 'CONFIRMADO' AS diagnostico_covid19, COUNT(*) AS \"Total_Obitos\" FROM orders"
    " WHERE o_orderstatus = 'F' GROUP BY ALL"
)
def monthly_outcomes_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, "monthly_outcomes_job", INPATIENTS, _patients(spark, sf_dir), "total_obitos")


def _daily(spark: SparkSession, label: str, spec: DatasetSpec, rows: DataFrame, output: str) -> DataFrame:
    layout = _land(spark, label, spec, rows)
    run_daily(spark, layout, [spec])
    return read_curated(spark, layout, output, f"{RUN_DATE:%Y%m%d}")


def _monthly(spark: SparkSession, label: str, spec: DatasetSpec, rows: DataFrame, output: str) -> DataFrame:
    layout = _land(spark, label, spec, rows)
    run_monthly(spark, layout, RUN_DATE, [spec])
    return read_curated(spark, layout, output, f"{RUN_DATE:%Y%m%d}")


@query(
    "SELECT CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS datahora,"
    " user_id::VARCHAR AS nome_drs, event_id::VARCHAR AS evento FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY datahora DESC NULLS LAST, evento DESC) = 1"
)
def beds_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest day of each region from three ways to write it; many ties, some texts that are no date."""
    return _daily(spark, "beds_job", BEDS, _beds(spark, sf_dir), "last_date_leitos")


@query(
    'SELECT c_name AS "Cidade", c_custkey AS "Rank_em_relacao_populacao_geral", c_nationkey::BIGINT AS "Dose_1",'
    ' c_custkey * 100000 AS "Populacao_senso_2020", c_mktsegment AS "Porcentagem_aplicação_Dose_1" FROM customer'
)
def ranking_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, "ranking_job", RANKING, _ranking(spark, sf_dir), "aplicacao_doses")


@query(
    'SELECT l_shipdate::DATE::VARCHAR AS "VACINA", l_orderkey AS "DOSE_1", l_partkey AS "DOSE_2",'
    ' l_suppkey AS "Dose_Unica", l_linenumber::BIGINT AS "DOSE_ADICIONAL_1", l_orderkey AS "DOSE_REFORCO_2",'
    ' l_orderkey + 1 AS "DOSE_REFORCO_3", NULL::BIGINT AS "DOSE_REFORCO_4",'
    ' l_partkey AS "REFORCO_FORA_DO_ESQUEMA_VACINAL" FROM lineitem'
)
def vaccines_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, "vaccines_job", VACCINES, _vaccines(spark, sf_dir), "estaticas_gerais_clean")


@query(
    "SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS id, 'true' AS condition FROM lineitem"
    " WHERE NOT coalesce(l_quantity <= 40 AND l_returnflag <> 'A', false)"
)
def microdata_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirteen condition flags: known, unknown, or not stated."""
    rows = _monthly(spark, "microdata_job", MICRODATA, _microdata(spark, sf_dir), "clean_microdados")
    return rows.select("id", "condition")


@query(
    'SELECT p_name AS "Ocupação", CASE WHEN p_size <> 7 THEN p_size::BIGINT END AS "casos_confirmados_COVID-19" FROM part'
)
def professionals_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, "professionals_job", PROFESSIONALS, _professionals(spark, sf_dir), "profissionais_casos_confirmados")


@query(
    'SELECT s_name AS "Municipio", s_nationkey::BIGINT AS "Total_Casos_Confirmados",'
    " DATE '2022-11-03' AS data_execucao FROM supplier"
)
def indigenous_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, "indigenous_job", INDIGENOUS, _indigenous(spark, sf_dir), "etnias_indigenas")


@query(
    'SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate::DATE END AS "Data_Coleta",'
    ' o_orderpriority AS "Tipo_Teste", o_custkey AS "Quantidade" FROM orders'
)
def tests_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, "tests_job", TESTS, _tests(spark, sf_dir), "total_testes")


# Appends


@query("SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def append_missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete a half-finished load: what is there, and what it lacked."""
    batch = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    present = batch.filter(F.col("l_linestatus") == "F")
    return present.unionAll(missing_rows(batch, present))


def _database(spark: SparkSession, name: str) -> JdbcTarget:
    """The database that ``spark.epilake.jdbc.url`` names, or a Derby inside the JVM of a local session."""
    url = spark.conf.get("spark.epilake.jdbc.url", None)
    if url is not None:
        return JdbcTarget(url)
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    return JdbcTarget(f"jdbc:derby:memory:{name};create=true", {"driver": driver}, connections=4)


@query(
    "SELECT *, DATE '2022-11-03' AS data_execucao FROM customer"
    " UNION ALL SELECT *, DATE '2022-11-04' AS data_execucao FROM customer"
)
def jdbc_overwrite_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a table twice and append a later run twice: two runs remain."""
    name = f"run_{uuid.uuid4().hex}"
    target = _database(spark, name)
    customer = table(spark, sf_dir, "customer")
    first = stamp(customer, "data_execucao", RUN_DATE)
    second = stamp(customer, "data_execucao", NEXT_DATE)
    for _ in range(2):
        overwrite_table(first, target, name)
    for _ in range(2):
        append_once(second, target, name, "data_execucao", "c_custkey")
    bounds = customer.agg(F.min("c_custkey"), F.max("c_custkey")).head()
    return read_table(spark, target, name, "c_custkey", tuple(bounds))


@query(
    "SELECT DISTINCT 'F' || l_suppkey AS nome_munic, l_suppkey AS codigo_ibge, NULL::BIGINT AS dias_sem_casos_novos"
    " FROM lineitem UNION ALL SELECT 'F' || l_suppkey, NULL, COUNT(*) FROM lineitem"
    " WHERE l_linenumber = 1 GROUP BY l_suppkey"
)
def export_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs of the case files, exported twice to the tables that hold them, and read back."""
    name = F.concat(F.lit("F"), F.col("l_suppkey").cast("string"))
    cases = table(spark, sf_dir, "lineitem").select(
        name.alias("nome_munic"), F.col("l_suppkey").alias("codigo_ibge"), (F.col("l_linenumber") - 1).alias("casos_novos")
    )
    layout = _land(spark, "export_tables", CASES, cases)
    run_daily(spark, layout, [CASES])
    target = _database(spark, f"export_{uuid.uuid4().hex}")
    loads = [load for load in LOADS if load.output in ("sem_casos_novos", "cidades_codigo")]
    for _ in range(2):
        codes, days = sorted(export(spark, layout, target, loads=loads))
    return read_table(spark, target, codes).unionByName(read_table(spark, target, days), allowMissingColumns=True)


@query(
    "WITH clean AS (SELECT l_suppkey, l_linenumber - 1 AS casos FROM lineitem WHERE l_returnflag <> 'A'),"
    " last_event AS (SELECT user_id, event_id::VARCHAR AS evento,"
    " CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS datahora FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY datahora DESC NULLS LAST, evento DESC) = 1),"
    " outcome AS (SELECT o_orderstatus, COUNT(*) AS n FROM orders"
    " GROUP BY o_orderstatus, o_orderpriority, month(o_orderdate), o_custkey % 100),"
    " loads AS ("
    " SELECT 'tb_raca_cor' AS tabela, COUNT(*) AS linhas, SUM(o_custkey % 100) AS soma, true AS inalterada FROM orders"
    " UNION ALL SELECT 'tb_aplicacao_doses', COUNT(*), SUM(c_nationkey), true FROM customer"
    " UNION ALL SELECT 'tb_cidades_codigo', COUNT(DISTINCT l_suppkey), SUM(DISTINCT l_suppkey), true FROM clean"
    " UNION ALL SELECT 'tb_clean_casos_obitos', COUNT(*), SUM(casos), true FROM clean"
    " UNION ALL SELECT 'tb_estaticas_gerais_clean', COUNT(*), SUM(l_orderkey), true FROM lineitem"
    " UNION ALL SELECT 'tb_last_date_leitos', COUNT(*), SUM(evento::BIGINT), false FROM last_event"
    " UNION ALL SELECT 'tb_sem_casos_novos', COUNT(DISTINCT l_suppkey), COUNT(*), false FROM clean WHERE casos = 0"
    " UNION ALL SELECT 'tb_clean_microdados', COUNT(*), SUM(l_orderkey * 10 + l_linenumber), false FROM lineitem"
    " WHERE NOT coalesce(l_quantity <= 40 AND l_returnflag <> 'A', false)"
    " UNION ALL SELECT 'tb_etnias_indigenas', COUNT(*), SUM(s_nationkey), false FROM supplier"
    " UNION ALL SELECT 'tb_profissionais_casos_confirmados', COUNT(*), SUM(CASE WHEN p_size <> 7 THEN p_size END), false FROM part"
    " UNION ALL SELECT 'tb_total_curados', COUNT(*), SUM(n), false FROM outcome WHERE o_orderstatus = 'O'"
    " UNION ALL SELECT 'tb_total_obitos', COUNT(*), SUM(n), false FROM outcome WHERE o_orderstatus = 'F')"
    " SELECT tabela, linhas::BIGINT AS linhas, soma::BIGINT AS soma, inalterada FROM loads"
)
def export_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twelve loads: an export that stops after five tables, and one that goes on.

    For each table its rows and the sum of one of its columns, read back from the
    database, and whether the second export found it loaded already.
    """
    layout = _lake(spark, "export_all_tables")
    daily_rows = ((CASES, _cases), (BEDS, _beds), (RANKING, _ranking), (VACCINES, _vaccines))
    monthly_rows = (
        (MICRODATA, _microdata), (PROFESSIONALS, _professionals), (INDIGENOUS, _indigenous),
        (INPATIENTS, _patients), (TESTS, _tests),
    )
    for spec, rows in (*daily_rows, *monthly_rows):
        _land_in(layout, spec, rows(spark, sf_dir))
    run_daily(spark, layout)
    run_monthly(spark, layout, RUN_DATE)
    target = _database(spark, f"export_{uuid.uuid4().hex}")
    export_loads(spark, layout, target, loads=LOADS[:5])
    parts = []
    summed = {
        "tb_raca_cor": "idade", "tb_aplicacao_doses": "Dose_1", "tb_cidades_codigo": "codigo_ibge",
        "tb_clean_casos_obitos": "casos_novos", "tb_estaticas_gerais_clean": "DOSE_1", "tb_last_date_leitos": "evento",
        "tb_sem_casos_novos": "dias_sem_casos_novos", "tb_clean_microdados": "id",
        "tb_etnias_indigenas": "Total_Casos_Confirmados",
        "tb_profissionais_casos_confirmados": "casos_confirmados_COVID-19", "tb_total_curados": "Total_Curados",
        "tb_total_obitos": "Total_Obitos",
    }
    for load in export_loads(spark, layout, target):
        rows = read_table(spark, target, load.table)
        total = F.sum(named(summed[load.table]).cast("bigint")).alias("soma")
        sums = rows.agg(F.count("*").alias("linhas"), total)
        parts.append(sums.select(F.lit(load.table).alias("tabela"), "linhas", "soma", F.lit(load.unchanged).alias("inalterada")))
    return reduce(DataFrame.unionByName, parts)


@query(
    "WITH last_event AS (SELECT user_id, event_id::BIGINT AS evento,"
    " CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS datahora FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY datahora DESC NULLS LAST, event_id::VARCHAR DESC) = 1)"
    " SELECT 'tb_cidades_codigo' AS tabela, COUNT(DISTINCT l_suppkey) AS linhas, SUM(DISTINCT l_suppkey)::BIGINT AS soma,"
    " 1::BIGINT AS cargas FROM lineitem WHERE l_returnflag <> 'A'"
    " UNION ALL SELECT 'tb_last_date_leitos', COUNT(*), SUM(evento)::BIGINT, 1 FROM last_event"
)
def transform_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform that fails for want of one batch, so nothing is loaded; then one that succeeds.

    For each table its rows, the sum of one of its columns, and how often it was loaded.
    """
    layout = _land(spark, "transform_then_load", CASES, _cases(spark, sf_dir))
    target = _database(spark, f"export_{uuid.uuid4().hex}")
    ledger = Ledger(target)
    ledger.prepare(spark)
    summed = {"tb_cidades_codigo": "codigo_ibge", "tb_last_date_leitos": "evento"}
    loads = [load for load in LOADS if load.table in summed]
    jobs = [lambda spark, layout: run_daily(spark, layout, [CASES, BEDS])]
    try:
        run_all(spark, layout, target, jobs, loads)
    except JobError:
        _land_in(layout, BEDS, _beds(spark, sf_dir))
    run_all(spark, layout, target, jobs, loads)
    entries = read_table(spark, target, ledger.name).toDF("load_no", "tabela", "source", "n_rows")
    counts = entries.groupBy("tabela").agg(F.count("*").alias("cargas"))
    sums = [
        read_table(spark, target, name).agg(F.count("*").alias("linhas"), F.sum(named(column).cast("bigint")).alias("soma"))
        .select(F.lit(name).alias("tabela"), "linhas", "soma")
        for name, column in summed.items()
    ]
    return reduce(DataFrame.unionByName, sums).join(counts, "tabela")


@query(
    "SELECT 'clean_table' AS visao, 'F' || l_suppkey AS nome_munic, COUNT(*) AS linhas, SUM(l_linenumber - 1)::BIGINT AS soma"
    " FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_suppkey"
    " UNION ALL SELECT 'table', o_orderpriority, COUNT(*), SUM(o_custkey % 100)::BIGINT FROM orders GROUP BY o_orderpriority"
)
def job_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL finds in the views that the jobs leave in the session."""
    layout = _land(spark, "job_views", CASES, _cases(spark, sf_dir))
    _land_in(layout, INPATIENTS, _patients(spark, sf_dir))
    run_daily(spark, layout, [CASES])
    run_monthly(spark, layout, RUN_DATE, [INPATIENTS])
    return spark.sql(
        "SELECT 'clean_table' AS visao, nome_munic, COUNT(*) AS linhas, SUM(casos_novos) AS soma FROM clean_table GROUP BY nome_munic"
        " UNION ALL SELECT 'table', nome_munic, COUNT(*), SUM(idade) FROM `table` GROUP BY nome_munic"
    )


# The order of landings, and what changed between them


@query("SELECT o_orderkey, o_totalprice, '20221103/grupo-7' AS lote FROM orders WHERE o_orderstatus = 'F'")
def batch_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch read by its run date and run id, although a later one is the current batch; both as its files' path has them."""
    layout, spec = _lake(spark, "batch_by_path"), DatasetSpec("pedidos", {"o_orderkey": "bigint", "o_totalprice": "double"})
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    first, _ = [
        _land_in(layout, spec, rows.filter(F.col("o_orderstatus") == status).drop("o_orderstatus"), batch_id)
        for status, batch_id in (("F", "grupo-7"), ("O", "grupo-8"))
    ]
    landed = spark.read.parquet(layout.batch_path(first))
    place = F.regexp_extract("_metadata.file_path", "/pedidos/([^/]+/[^/]+)/pedidos.parquet/", 1)
    return apply_types(landed.select("*", place.alias("lote")), spec.columns)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def landing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later landing of an earlier date, with a smaller id: the batch that landed last is the current one."""
    layout, spec = _lake(spark, "landing_order"), DatasetSpec("pedidos", {"o_orderkey": "bigint", "o_totalprice": "double"})
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for status, batch_id, date in (("F", "z", NEXT_DATE), ("O", "a", RUN_DATE)):
        _land_in(layout, spec, rows.filter(F.col("o_orderstatus") == status).drop("o_orderstatus"), batch_id, date)
    return read_batch(spark, layout, spec, latest_batches(spark, layout, [spec.name])[spec.name])


@query(
    "SELECT * FROM (VALUES ('added', 'o_clerk', NULL, 'string'), ('gone', 'o_custkey', 'bigint', NULL),"
    " ('reordered', 'o_orderstatus', NULL, NULL), ('retyped', 'o_totalprice', 'double', 'string'))"
    " AS t(mudanca, coluna, antes, depois)"
    " WHERE (SELECT COUNT(*) FROM orders) > 0"
)
def landing_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the columns of a batch differ from those of the batch before."""
    layout, spec = _lake(spark, "landing_drift"), DatasetSpec("pedidos", {})
    orders = table(spark, sf_dir, "orders")
    first = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    price = F.format_string("R$ %.2f", "o_totalprice").alias("o_totalprice")
    second = orders.select("o_orderstatus", "o_orderkey", price, F.col("o_orderpriority").alias("o_clerk"))
    _land_in(layout, spec, first, "r1")
    drift = _land_in(layout, spec, second, "r2").drift
    before, after = dict(first.dtypes), dict(second.dtypes)
    rows = [("added", name, None, after[name]) for name in drift.added]
    rows += [("gone", name, before[name], None) for name in drift.gone]
    rows += [("reordered", name, None, None) for name in drift.reordered]
    rows += [("retyped", name, old, new) for name, (old, new) in drift.retyped.items()]
    return spark.createDataFrame(rows, "mudanca STRING, coluna STRING, antes STRING, depois STRING")
