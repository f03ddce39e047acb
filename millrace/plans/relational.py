"""Selections, joins, catalogue and source jobs."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from millrace.functions.numbers import hash_bucket
from millrace.operators import aggregates as agg
from millrace.operators import relational as rel
from millrace.plans.inputs import (
    CHURN_FEATURES, SQL_CHURN, churn, log_lines, sql_hash,
)
from millrace.plans.registry import TABLES, query
from millrace.session import new_folder
from millrace.sources import files
from millrace.sources.inventory import file_inventory, list_files, table_files


# ---- sources and sinks --------------------------------------------------------------------

SEGMENTS = [("BUILDING", 1), ("MACHINERY", 2), ("HOUSEHOLD", 3), ("AUTOMOBILE", 4), ("FURNITURE", 5)]  # fixed values
_SQL_SEGMENTS = f"(VALUES {', '.join(map(str, SEGMENTS))}) AS s(c_mktsegment, rank)"


@query("inline_rows", f"SELECT c_custkey, c_mktsegment, rank FROM customer JOIN {_SQL_SEGMENTS} USING (c_mktsegment)")
def inline_rows(t):
    ranks = files.inline_rows(t.spark, SEGMENTS, "c_mktsegment string, rank int", 2)
    return t.customer.join(ranks, "c_mktsegment").select("c_custkey", "c_mktsegment", "rank")


@query("infer_schema", f"""
SELECT c_mktsegment, CAST(rank AS BIGINT) AS rank, count(*) AS n FROM customer
JOIN {_SQL_SEGMENTS} USING (c_mktsegment) GROUP BY ALL
""")
def infer_schema(t):
    ranks = files.inferred_rows(t.spark, [{"c_mktsegment": s, "rank": r} for s, r in SEGMENTS])
    return agg.count_by_key(t.customer.join(ranks, "c_mktsegment"), "c_mktsegment", "rank")


@query("apply_schema", "SELECT c_name, c_custkey, c_acctbal FROM customer")
def apply_schema(t):
    schema = StructType([
        StructField("c_name", StringType(), False),
        StructField("c_custkey", LongType(), False),
        StructField("c_acctbal", DoubleType(), False),
    ])
    return files.apply_schema(t.customer, schema)


@query("text_lines", """
SELECT count(*) AS n_lines, count(*) FILTER (event_id % 97 = 0) AS n_unquoted FROM events
""")
def text_lines(t):
    path = new_folder(t.spark, "log-text")
    log_lines(t).write.text(path)
    return files.text_lines(t.spark, path).agg(
        F.count("*").alias("n_lines"), F.count_if(~F.col("value").contains('"')).alias("n_unquoted")
    )


@query("parquet_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def parquet_roundtrip(t):
    saved = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return files.parquet_roundtrip(saved, new_folder(t.spark, "orders"))


@query("materialise_or_load", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1
""")
def materialise_or_load(t):
    path = new_folder(t.spark, "priority-totals")

    def compute() -> DataFrame:
        return t.orders.groupBy("o_orderpriority").agg(
            F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )

    files.materialise_or_load(t.spark, path, compute)
    return files.materialise_or_load(t.spark, path, compute)


@query("temp_views", """
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def temp_views(t):
    t.customer.createOrReplaceTempView("millrace_customer")
    t.nation.createOrReplaceTempView("millrace_nation")
    return t.spark.sql("""
        SELECT n_name, count(*) AS n_customers
        FROM millrace_customer JOIN millrace_nation ON c_nationkey = n_nationkey GROUP BY n_name
    """)


@query("csv_with_header", f"""
WITH {SQL_CHURN}
SELECT label, count(*) AS n, CAST(6 AS INTEGER) AS n_inputs, round(sum(n_view), 4) AS views,
       round(sum(max_value), 4) AS values FROM churn GROUP BY 1
""")
def csv_with_header(t):
    path = new_folder(t.spark, "churn-csv")
    table = churn(t).select(*CHURN_FEATURES, "label")
    table.write.option("header", True).csv(path)
    read = files.csv_with_header(t.spark, path, ", ".join(f"{c} double" for c in CHURN_FEATURES) + ", label int")
    rows = files.features_and_label(read)
    return rows.groupBy("label").agg(
        F.count("*").alias("n"),
        F.max(F.size("features")).alias("n_inputs"),
        F.round(F.sum(F.col("features")[0]), 4).alias("views"),
        F.round(F.sum(F.col("features")[5]), 4).alias("values"),
    )


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))


def product_lines(t) -> DataFrame:
    """Quoted product lines from ``part`` with a header line. Some names hold commas and quotes; some lines have
    an open quote, a field too few, or no name."""
    key = F.col("p_partkey")
    name = F.when(key % 7 == 0, F.concat("p_name", F.lit(', "new"'))).otherwise(F.col("p_name"))
    fields = [_quoted(F.when(key % 53 == 1, "").otherwise(name)), _quoted(F.col("p_type")), _quoted(F.col("p_brand"))]
    whole = F.concat_ws(",", _quoted(key), *fields, F.col("p_retailprice").cast("string"))
    body = t.part.select(
        F.when(key % 53 == 2, F.regexp_replace(whole, '"([^"]*)$', "$1"))
        .when(key % 53 == 3, F.concat_ws(",", _quoted(key), *fields))
        .otherwise(whole).alias("value")
    )
    # fixed values: the header of the product files
    header = t.spark.createDataFrame([('"id","name","description","manufacturer","price"',)], "value string")
    return body.unionByName(header)


SQL_PRODUCTS = """
product AS (
  SELECT p_partkey, '"' || p_partkey || '",' AS k,
         replace(CASE WHEN p_partkey % 7 = 0 THEN p_name || ', "new"' ELSE p_name END, '"', '') AS name,
         '"' || replace(CASE WHEN p_partkey % 53 = 1 THEN '' WHEN p_partkey % 7 = 0 THEN p_name || ', "new"' ELSE p_name END, '"', '""')
           || '","' || p_type || '","' || p_brand AS middle, p_type, p_brand FROM part)
"""


@query("delimited_with_rejects", f"""
WITH {SQL_PRODUCTS}
SELECT 1 AS status, CAST(p_partkey AS VARCHAR) AS id, name || ' ' || p_type || ' ' || p_brand AS text, '' AS rejected, 0 AS n_quotes
FROM product WHERE p_partkey % 53 NOT IN (1, 2, 3)
UNION ALL SELECT 0, '', '', '', 0
UNION ALL SELECT -1, '', '', k || middle, length(middle) - length(replace(middle, '"', '')) + CASE p_partkey % 53 WHEN 2 THEN 2 ELSE 3 END
FROM product WHERE p_partkey % 53 IN (1, 2, 3)
""")
def delimited_with_rejects(t):
    """All three outcomes. A rejected line is shown up to its last quote, with the number of its quotes."""
    path = new_folder(t.spark, "product-lines")
    product_lines(t).write.text(path)
    parsed = files.product_status(files.text_lines(t.spark, path))
    broken = F.col("status") == -1
    shown = F.regexp_replace("value", '"?(,[0-9.]+)?$', "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return parsed.select(
        "status", "id", "text", F.when(broken, shown).alias("rejected"), F.when(broken, quotes).cast("long").alias("n_quotes")
    ).fillna({"id": "", "text": "", "rejected": "", "n_quotes": 0})


@query("remove_quotes", f"""
WITH {SQL_PRODUCTS}
SELECT CAST(p_partkey AS VARCHAR) AS id, name || ' ' || p_type || ' ' || p_brand AS text FROM product WHERE p_partkey % 53 NOT IN (1, 2, 3)
""")
def remove_quotes(t):
    return files.product_status(product_lines(t)).where("status = 1").select("id", "text")


def gold_lines(t) -> DataFrame:
    """Known duplicates from ``orders``: a customer's id and the address of an order, some of it with commas and
    quotes; some lines have one field, three, none, or an open quote."""
    key = F.col("o_orderkey")
    left = _quoted(F.concat(F.lit("c"), "o_custkey"))
    right = _quoted(F.concat(F.lit("http://shop/o?k="), key, F.when(key % 5 == 0, F.lit(',"x"')).otherwise("")))
    body = t.orders.select(
        F.when(key % 61 == 1, left)
        .when(key % 61 == 2, F.concat_ws(",", left, right, F.lit("1")))
        .when(key % 61 == 3, F.lit(""))
        .when(key % 61 == 4, F.concat(left, F.lit(',"open'), key))
        .when(key % 61 == 5, F.concat_ws(",", left, F.lit('""')))
        .otherwise(F.concat_ws(",", left, right)).alias("value")
    )
    header = t.spark.createDataFrame([('"idLeft","idRight"',)], "value string")
    return body.unionByName(header)


@query("gold_file", """
WITH line AS (
  SELECT o_orderkey AS k, o_orderkey % 61 AS kind, 'c' || o_custkey AS l,
         'http://shop/o?k=' || o_orderkey || CASE WHEN o_orderkey % 5 = 0 THEN ',x' ELSE '' END AS r,
         '"http://shop/o?k=' || o_orderkey || CASE WHEN o_orderkey % 5 = 0 THEN ',""x""' ELSE '' END || '"' AS q FROM orders)
SELECT 1 AS status, l AS left_id, r AS right_id, NULL AS rejected FROM line WHERE kind NOT BETWEEN 1 AND 5
UNION ALL SELECT 0, NULL, NULL, NULL
UNION ALL SELECT -1, NULL, NULL, CASE kind WHEN 1 THEN '"' || l || '"' WHEN 2 THEN '"' || l || '",' || q || ',1' WHEN 3 THEN ''
          WHEN 4 THEN '"' || l || '","open' || k ELSE '"' || l || '",""' END FROM line WHERE kind BETWEEN 1 AND 5
""")
def gold_file(t):
    """The file of known duplicates, all three outcomes: header, pairs, and broken lines as they are."""
    path = new_folder(t.spark, "gold-lines")
    gold_lines(t).write.text(path)
    parsed = files.gold_status(files.text_lines(t.spark, path))
    return parsed.select("status", "left_id", "right_id", F.when(F.col("status") == -1, F.col("value")).alias("rejected"))


def _vector_text(t) -> DataFrame:
    return t.embeddings.select(
        F.concat_ws(
            " ",
            F.concat(F.lit("v"), F.col("vec_id")),
            F.transform("embedding", lambda x: x.cast("double").cast("string")),
        ).alias("value")
    )


@query("word_vector_file", """
SELECT 'v' || vec_id AS word, CAST(len(embedding) AS INTEGER) AS n,
       round(CAST(embedding[1] AS DOUBLE), 9) AS first, round(CAST(embedding[-1] AS DOUBLE), 9) AS last
FROM embeddings
""")
def word_vector_file(t):
    path = new_folder(t.spark, "vector-text")
    _vector_text(t).write.text(path)
    return files.word_vector_file(files.text_lines(t.spark, path)).select(
        "word",
        F.size("vec").alias("n"),
        F.round(F.element_at("vec", 1), 9).alias("first"),
        F.round(F.element_at("vec", -1), 9).alias("last"),
    )


@query("numeric_matrix", """
SELECT i AS column, count(*) AS n, round(sum(v), 5) AS total
FROM (SELECT unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY 1
""")
def numeric_matrix(t):
    path = new_folder(t.spark, "matrix-text")
    _vector_text(t).select(F.regexp_replace("value", r"^\S+ ", "").alias("value")).write.text(path)
    rows = files.numeric_matrix(files.text_lines(t.spark, path))
    return (
        rows.select(F.posexplode("row").alias("column", "v"))
        .groupBy(F.col("column").cast("bigint").alias("column"))
        .agg(F.count("*").alias("n"), F.round(F.sum("v"), 5).alias("total"))
    )


@query("tagged_multi_file", f"""
SELECT CASE WHEN {sql_hash(3, 'doc_id')} % 2 = 0 THEN 'train' ELSE 'test' END AS split,
       quality AS label, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM (SELECT doc_id, quality, regexp_replace(text, '[\\n\\r]', ' ', 'g') AS text
      FROM documents JOIN labels USING (doc_id)) GROUP BY ALL
""")
def tagged_multi_file(t):
    path = new_folder(t.spark, "reviews")
    part = F.when(hash_bucket(3, 2, "doc_id") == 0, "train").otherwise("test")
    label = F.when(F.col("quality") == 1, "pos").otherwise("neg")
    (
        t.documents.join(t.labels, "doc_id")
        .select(
            F.regexp_replace("text", r"[\n\r]", " ").alias("value"),
            F.concat_ws("-", part, label).alias("tag"),
        )
        .write.partitionBy("tag")
        .text(path)
    )
    names = [f"{path}/tag={s}-{k}" for s in ("train", "test") for k in ("pos", "neg")]
    return files.tagged_multi_file(t.spark, names).groupBy("split", "label").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars")
    )


@query("json_sink", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1
""")
def json_sink(t):
    path = new_folder(t.spark, "segments-json")
    files.json_sink(
        t.customer.groupBy("c_mktsegment").agg(
            F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean")
        ),
        path,
    )
    return t.spark.read.schema("c_mktsegment string, n bigint, mean double").json(path)


@query("file_inventory", "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", count(*) AS n_rows, true AS is_listed FROM {name}""" for name in TABLES))
def files_listed(t):
    """Rows in the files of each table, and whether the folder's listing finds the same files and bytes."""
    found = []
    for name in TABLES:
        held = table_files(t.spark.read.parquet(f"{t.folder}/{name}.parquet"))
        listed = file_inventory(list_files(t.spark, f"{t.folder}/{name}.parquet", "*.parquet"))
        both = listed.select(F.struct(F.col("total_bytes").alias("length"), F.col("n_files").alias("n"))).scalar()
        read = F.struct(F.sum("length").alias("length"), F.count("*").alias("n"))
        found.append(held.agg(F.lit(name).alias("table"), F.sum("n_rows").alias("n_rows"), (read == both).alias("is_listed")))
    return reduce(DataFrame.unionByName, found)


COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount"
                " l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _inventory_sql(shown: str) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS "table", '{column}' AS "column", {i} AS ordinal, count(*) AS n_rows,
       count({column}) AS n_filled, {shown.format(column)} FROM {table}"""
        for table, columns in COLUMNS.items()
        for i, column in enumerate(columns.split(), 1)
    )


@query("column_inventory", _inventory_sql("count(DISTINCT {0}) AS n_distinct"))
def column_inventory(t):
    return reduce(DataFrame.unionByName, [agg.column_profile(getattr(t, n), n) for n in TABLES])


@query("column_inventory_sketch", _inventory_sql("true AS is_close"))
def column_inventory_sketch(t):
    """The inventory from sketches, and whether each estimate is within 5 % of the exact number of values."""
    sketched = reduce(DataFrame.unionByName, [agg.column_sketches(getattr(t, n), n) for n in TABLES])
    exact = reduce(DataFrame.unionByName, [agg.distinct_values(getattr(t, n), n) for n in TABLES])
    close = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return sketched.join(exact, ["table", "ordinal"]).select("table", "column", "ordinal", "n_rows", "n_filled", close.alias("is_close"))


# ---- selection ----------------------------------------------------------------------------


@query("project_columns", "SELECT c_name, c_mktsegment FROM customer")
def project_columns(t):
    return t.customer.select("c_name", "c_mktsegment")


@query("filter_le", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size <= 20")
def filter_le(t):
    return t.part.where("p_size <= 20").select("p_partkey", "p_name", "p_size")


@query("lines_containing", """
SELECT count(*) FILTER (contains(line, 'a')) AS with_a, count(*) FILTER (contains(line, 'b')) AS with_b
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
""")
def lines_containing(t):
    lines = t.documents.select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.agg(
        F.count_if(F.col("line").contains("a")).alias("with_a"),
        F.count_if(F.col("line").contains("b")).alias("with_b"),
    )


@query("key_lookup", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey = 7 AND l_linenumber = 1
""")
def key_lookup(t):
    return rel.key_lookup(t.lineitem, l_orderkey=7, l_linenumber=1).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("column_slice", """
SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10
""")
def column_slice(t):
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    """The six first and six last columns, eleven in all as one is both, of the first ten rows."""
    return rel.column_slice(t.lineitem, 6, 10, order)


@query("feature_prep", """
SELECT c_custkey, CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS DOUBLE) AS c_building,
       CAST(c_nationkey AS DOUBLE) AS c_nationkey, c_acctbal,
       CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS label FROM customer
""")
def feature_prep(t):
    from millrace.operators.features import feature_prep as prep

    table = t.customer.select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("c_building"),
        F.when(F.col("c_acctbal") < 0, "True.").otherwise("False.").alias("churn"),
    )
    return prep(table, key="c_custkey", drop=["c_name"], yes_no=["c_building"], label="churn")


# ---- joins --------------------------------------------------------------------------------


def _label_join(t, how):
    # neither table holds all ids of the other
    vectors = t.embeddings.select("vec_id", F.col("label").alias("cluster"))
    labels = t.labels.select("doc_id", "quality", "toxic")
    found = rel.joined(labels, vectors, "doc_id", "vec_id", how)
    return found.select(*[F.col(c).cast("string").alias(c) for c in ("quality", "toxic", "cluster")])


def _label_sql(how):
    columns = "CAST(quality AS VARCHAR) AS quality, CAST(toxic AS VARCHAR) AS toxic, CAST(e.label AS VARCHAR) AS cluster"
    return f"SELECT {columns} FROM labels l {how} JOIN embeddings e ON doc_id = vec_id"


@query("join_inner", _label_sql("INNER"))
def join_inner(t):
    return _label_join(t, "inner")


@query("join_left", _label_sql("LEFT"))
def join_left(t):
    return _label_join(t, "left")


@query("join_right", _label_sql("RIGHT"))
def join_right(t):
    return _label_join(t, "right")


@query("join_full", _label_sql("FULL"))
def join_full(t):
    return _label_join(t, "full")


@query("pair_key", "SELECT l_orderkey || ' ' || l_linenumber AS pair, count(*) AS n FROM lineitem GROUP BY 1")
def pair_key(t):
    """Grouped on the two columns; the text is built once per group."""
    counted = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return counted.select(rel.pair_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("pair"), "n")


@query("swap_key", """
SELECT DISTINCT l_suppkey, l_partkey, CAST(l_linenumber AS INTEGER) AS l_linenumber FROM lineitem
""")
def swap_key(t):
    return rel.swap_key(t.lineitem, "l_linenumber", "l_suppkey", "l_partkey").distinct()
