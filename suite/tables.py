"""Scans, filters, row changes, files and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.fixtures import exact_sum, fresh_name, read, workspace
from suite.registry import query
from tidemark.operators import filters, quality, rows
from tidemark.operators.query import sql
from tidemark.sources import csvfiles, snapshots

CUT = "1998-01-01"


@query("SELECT * FROM orders")
def table_scan(spark, sf_dir):
    return read(spark, sf_dir, "orders")


@query("""
SELECT c_mktsegment, count(*) AS n FROM customer
WHERE c_acctbal > 1000 AND c_nationkey <> 3 GROUP BY c_mktsegment""")
def sql_params(spark, sf_dir):
    """SQL with named parameters over a frame."""
    return sql(spark, """
        SELECT c_mktsegment, count(*) AS n FROM {customer}
        WHERE c_acctbal > :floor AND c_nationkey <> :nation GROUP BY c_mktsegment;""",
               {"floor": 1000, "nation": 3}, customer=read(spark, sf_dir, "customer"))


@query("""
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 1""")
def first_row(spark, sf_dir):
    """The dearest order."""
    ranked = filters.structured_select(
        read(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"],
        order_by=["o_totalprice DESC", "o_orderkey"])
    return filters.first_row(ranked)


@query("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def first_value(spark, sf_dir):
    ranked = filters.structured_select(
        read(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"],
        order_by=["o_totalprice DESC", "o_orderkey"])
    return filters.first_value(ranked)


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE (o_orderstatus = 'O' OR o_totalprice > 100000)
ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey ASC NULLS LAST LIMIT 50 OFFSET 20""")
def structured_select(spark, sf_dir):
    return filters.structured_select(
        read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
        "o_orderstatus = 'O' OR o_totalprice > 100000",
        ["o_totalprice DESC", "o_orderkey"], limit=50, offset=20)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def where_dict(spark, sf_dir):
    return filters.where_dict(
        read(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"})


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = NULL")
def where_null(spark, sf_dir):
    """A None value matches nothing."""
    return filters.count_where(
        read(spark, sf_dir, "orders"), {"o_orderstatus": "F", "o_orderpriority": None})


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND (l_discount > 0.05 OR l_quantity < 10)""")
def raw_predicate(spark, sf_dir):
    recent = filters.raw_predicate(read(spark, sf_dir, "lineitem"),
                                   "l_shipdate >= timestamp_ntz'1997-01-01 00:00:00'")
    return filters.raw_predicate(recent, "l_discount > 0.05 OR l_quantity < 10").select(
        "l_orderkey", "l_linenumber", "l_shipdate")


@query("SELECT count(*) > 0 AS found FROM customer WHERE c_mktsegment = 'BUILDING'")
def exists_rows(spark, sf_dir):
    return filters.exists_rows(read(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING"})


@query("SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def count_where(spark, sf_dir):
    return filters.count_where(
        read(spark, sf_dir, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F"})


@query(f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'")
def incremental_extract(spark, sf_dir):
    """Rows above a high-water mark."""
    import datetime as dt

    return filters.newer_than(
        read(spark, sf_dir, "orders"), "o_orderdate", dt.datetime.fromisoformat(CUT))


@query("""
SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'
ORDER BY c_nationkey ASC NULLS LAST, c_custkey DESC NULLS FIRST LIMIT 40 OFFSET 10""")
def paginate(spark, sf_dir):
    """The direction applies to the last column."""
    return filters.paginate(read(spark, sf_dir, "customer"), ["c_nationkey", "c_custkey"],
                            40, 10, {"c_mktsegment": "MACHINERY"}, descending=True)


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM lineitem
ORDER BY l_returnflag, l_shipdate, l_orderkey, l_linenumber DESC NULLS FIRST LIMIT 100 OFFSET 5000""")
def paginate_deep(spark, sf_dir):
    """A page far down the order is found by counts; its keys have few values, then many."""
    return filters.paginate(
        read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber"], 100, 5000,
        columns=["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"], descending=True, seek_from=500)


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_mktsegment IS NOT NULL")
def distinct_values(spark, sf_dir):
    return rows.distinct_values(read(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


@query("SELECT max(o_orderkey) AS watermark FROM orders")
def batch_watermark(spark, sf_dir):
    from tidemark.plans.etl import batch_watermark as mark

    return mark(read(spark, sf_dir, "orders"), "o_orderkey")


@query("""
SELECT doc_id, lower(trim(lang)) AS lang, lower(trim(source)) AS source, n_chars FROM documents
WHERE lang IS NOT NULL AND n_chars IS NOT NULL""")
def clean_transform(spark, sf_dir):
    """Documented cleaning steps: drop NULLs, then trim and lower-case."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return rows.trim_lower("lang", "source")(rows.drop_nulls("lang", "n_chars")(docs))


@query("""
SELECT c.c_custkey, c.c_name, n.n_nationkey AS nation_id FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def key_mapping(spark, sf_dir):
    return rows.key_mapping(
        read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"),
        read(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, "n_nationkey", "nation_id"
    ).drop("c_nationkey")


@query("""
SELECT c.c_custkey, (SELECT min(o_orderkey) FROM orders o WHERE o.o_custkey = c.c_custkey)
         AS some_order FROM customer c""")
def lookup_one(spark, sf_dir):
    return rows.lookup_one(read(spark, sf_dir, "customer").select("c_custkey"),
                           read(spark, sf_dir, "orders"), {"c_custkey": "o_custkey"},
                           "o_orderkey", "some_order")


# --- row changes ------------------------------------------------------------------

def _ledger(spark, sf_dir, late: bool):
    """Orders per customer up to the cut (the target) or after it (the batch)."""
    orders = read(spark, sf_dir, "orders")
    cut = F.lit(CUT).cast("timestamp_ntz")
    part = orders.filter(F.col("o_orderdate") >= cut if late else F.col("o_orderdate") < cut)
    columns = [exact_sum("o_totalprice").alias("spent"), F.max("o_orderkey").alias("last_order")]
    if not late:
        columns.append(F.count(F.lit(1)).alias("early_orders"))
    return part.groupBy("o_custkey").agg(*columns)


SQL_LEDGER = f"""
WITH old AS (
  SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
         max(o_orderkey) AS last_order, count(*) AS early_orders
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1),
new AS (
  SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
         max(o_orderkey) AS last_order
  FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}' GROUP BY 1),
merged AS (
  SELECT coalesce(new.o_custkey, old.o_custkey) AS o_custkey,
         CASE WHEN new.o_custkey IS NOT NULL THEN new.spent ELSE old.spent END AS spent,
         CASE WHEN new.o_custkey IS NOT NULL THEN new.last_order ELSE old.last_order END
           AS last_order, old.early_orders, new.o_custkey IS NOT NULL AS changed
  FROM old FULL JOIN new ON old.o_custkey = new.o_custkey)
"""


@query(SQL_LEDGER + "SELECT o_custkey, spent, last_order, early_orders FROM merged")
def upsert_merge(spark, sf_dir):
    """Late orders update or insert into the ledger of early ones."""
    return rows.upsert(_ledger(spark, sf_dir, False), _ledger(spark, sf_dir, True), "o_custkey")


@query(SQL_LEDGER + "SELECT o_custkey, spent, last_order, early_orders FROM merged WHERE changed")
def upsert_returning(spark, sf_dir):
    return rows.upsert_returning(
        _ledger(spark, sf_dir, False), _ledger(spark, sf_dir, True), "o_custkey")


@query(SQL_LEDGER + """
SELECT o_custkey, spent, last_order, early_orders FROM old
UNION ALL SELECT o_custkey, spent, last_order, NULL FROM new
WHERE o_custkey NOT IN (SELECT o_custkey FROM old)""")
def insert_ignore(spark, sf_dir):
    """Late customers join the ledger only when it does not know them."""
    tables, name = workspace(spark, "ignore"), fresh_name("ledger")
    tables.write(_ledger(spark, sf_dir, False), name)
    tables.insert_ignore(_ledger(spark, sf_dir, True), name, "o_custkey")
    return tables.read(name)


@query("SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 50000)")
def delete_where(spark, sf_dir):
    tables, name = workspace(spark, "delete"), fresh_name("orders")
    tables.write(read(spark, sf_dir, "orders"), name)
    tables.delete(name, "o_orderstatus = 'F' AND o_totalprice < 50000")
    return tables.read(name)


@query("""
WITH top AS (SELECT max(o_totalprice) AS price FROM orders),
merged AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 0.98 * price THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority FROM orders, top
  UNION ALL SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
  FROM orders, top WHERE o_totalprice > 0.98 * price)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'N' THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM merged WHERE o_orderkey <> 1""")
def upsert_touched_files(spark, sf_dir):
    """A keyed table of all orders: the dearest are corrected and added once more, one is deleted, some updated."""
    tables, name = workspace(spark, "segments"), fresh_name("orders")
    orders = read(spark, sf_dir, "orders")
    tables.create_keyed(orders, name, "o_orderkey", 16)
    top = orders.agg(F.max("o_totalprice").alias("_price"))
    dearest = orders.join(F.broadcast(top), F.col("o_totalprice") > 0.98 * F.col("_price")).drop("_price")
    again = dearest.withColumn("o_orderkey", -F.col("o_orderkey")).withColumn("o_orderstatus", F.lit("N"))
    tables.upsert(dearest.withColumn("o_orderstatus", F.lit("X")).unionByName(again), name, "o_orderkey")
    tables.delete(name, {"o_orderkey": 1})
    tables.update(name, {"o_totalprice": 0.0}, {"o_orderstatus": "N"})
    return tables.read(name)


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'X' ELSE o_orderstatus END
         AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def update_where(spark, sf_dir):
    tables, name = workspace(spark, "update"), fresh_name("orders")
    tables.write(read(spark, sf_dir, "orders"), name)
    tables.update(name, {"o_orderstatus": "X", "o_totalprice": 0.0},
                  {"o_orderpriority": "5-LOW"})
    return tables.read(name)


@query("SELECT count(*) AS n FROM orders WHERE false")
def truncate_rows(spark, sf_dir):
    tables, name = workspace(spark, "truncate"), fresh_name("orders")
    tables.write(read(spark, sf_dir, "orders"), name)
    tables.truncate(name)
    return filters.count_where(tables.read(name))


@query("""
SELECT * FROM orders WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def fk_cascade(spark, sf_dir):
    return rows.on_parent_delete(
        read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"),
        {"c_mktsegment": "BUILDING"}, "o_custkey", "c_custkey", "CASCADE")


@query("""
SELECT o_orderkey, CASE WHEN c.c_custkey IS NULL THEN o_custkey END AS o_custkey, o_totalprice
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON o_custkey = c.c_custkey""")
def fk_set_null(spark, sf_dir):
    return rows.on_parent_delete(
        read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        read(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING"}, "o_custkey", "c_custkey",
        "SET NULL")


@query("""
SELECT o_orderkey, CASE WHEN c.c_custkey IS NULL THEN o_custkey ELSE -1 END AS o_custkey,
       o_totalprice
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON o_custkey = c.c_custkey""")
def fk_set_default(spark, sf_dir):
    return rows.on_parent_delete(
        read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        read(spark, sf_dir, "customer"), {"c_mktsegment": "BUILDING"}, "o_custkey", "c_custkey",
        "SET DEFAULT", {"o_custkey": -1})


@query("""
SELECT count(*) AS blocking_rows FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def fk_restrict(spark, sf_dir):
    return rows.on_parent_delete(
        read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer"),
        {"c_mktsegment": "BUILDING"}, "o_custkey", "c_custkey", "RESTRICT")


# --- sinks and files --------------------------------------------------------------

@query("""
SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(12,2)) AS s_acctbal FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) FROM customer""")
def write_modes(spark, sf_dir):
    """Write, replace with a type override and a key check, then append."""
    tables, name = workspace(spark, "modes"), fresh_name("party")
    supplier = read(spark, sf_dir, "supplier")
    customer = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"), F.col("c_acctbal").alias("s_acctbal"))
    tables.write(customer, name, "fail")
    tables.write(supplier, name, "replace", {"s_acctbal": "decimal(12,2)"}, "s_suppkey")
    tables.write(customer, name, "append")
    return tables.read(name)


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, NULL::DOUBLE AS o_totalprice, o_orderdate,
       NULL::VARCHAR AS o_orderpriority FROM orders""")
def bulk_append(spark, sf_dir):
    """Append a column list; columns not given are NULL."""
    tables, name = workspace(spark, "append"), fresh_name("orders")
    orders = read(spark, sf_dir, "orders")
    tables.write(rows.truncate(orders), name)
    tables.append(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), name)
    return tables.read(name)


@query("""
SELECT doc_id, lang, CASE WHEN n_chars % 2 = 0 THEN source END AS source, n_chars, text
FROM documents""")
def csv_roundtrip(spark, sf_dir):
    """Export and import whole documents, with NULLs, quotes and line breaks."""
    tables, name = workspace(spark, "csv"), fresh_name("documents")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.when(F.col("n_chars") % 2 == 0, F.col("source")).alias("source"), "n_chars", "text")
    tables.write(rows.truncate(docs), name)
    path = f"{tables.root}/export"
    csvfiles.export_csv(docs, path, delimiter=";", null_string="\\N")
    csvfiles.import_csv(tables, path, name, delimiter=";", null_string="\\N", multi_line=True)
    return tables.read(name)


@query("""
SELECT 'nation' AS t, n_nationkey AS k, n_name AS name, n_regionkey AS parent,
  CAST(NULL AS DOUBLE) AS balance, CAST(NULL AS VARCHAR) AS segment FROM nation
UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def snapshot_restore(spark, sf_dir):
    """Save four tables, leave one out, restore the rest under new names."""
    tables = workspace(spark, "snapshot")
    stems = ["region", "nation", "customer", "supplier"]
    names = {stem: fresh_name(stem) for stem in stems}
    for stem, name in names.items():
        tables.write(read(spark, sf_dir, stem), name)
    path = f"{tables.root}/saved"
    snapshots.save(tables, names.values(), path, exclude=[names["region"]])
    snapshots.load(tables, path, prefix="restored_")
    parts = []
    for stem, short in (("nation", "n_nation"), ("customer", "c_cust"), ("supplier", "s_supp")):
        df = tables.read(f"restored_{names[stem]}")
        parent = {"nation": "n_regionkey"}.get(stem, f"{short[0]}_nationkey")
        balance, segment = f"{short[0]}_acctbal", f"{short[0]}_mktsegment"
        parts.append(df.select(
            F.lit(stem).alias("t"), F.col(f"{short}key").cast("long").alias("k"), F.col(f"{short[0]}_name").alias("name"),
            F.col(parent).cast("long").alias("parent"),
            (F.col(balance) if balance in df.columns else F.lit(None).cast("double")).alias("balance"),
            (F.col(segment) if segment in df.columns else F.lit(None).cast("string")).alias("segment")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events")
def nan_to_null(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", F.when(
        F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return rows.nan_to_null(events)


# --- checks -----------------------------------------------------------------------

@query("""
SELECT CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END AS l_orderkey, l_returnflag,
       count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 OR
       CASE WHEN l_orderkey % 97 <> 0 THEN l_orderkey END IS NULL""")
def pk_violations(spark, sf_dir):
    broken = read(spark, sf_dir, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_orderkey") % 97 != 0, F.col("l_orderkey")))
    return quality.pk_violations(broken, ["l_orderkey", "l_returnflag"])


@query("""
SELECT k, count(*) AS n FROM
  (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS k FROM orders) q
WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1""")
def unique_violations(spark, sf_dir):
    keyed = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("k"))
    return quality.unique_violations(keyed, "k")


@query("""
SELECT k AS l_partkey, count(*) AS n FROM
  (SELECT CASE WHEN l_partkey % 11 = 0 THEN l_partkey + 10000000
               WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey END AS k FROM lineitem) q
WHERE k IS NOT NULL AND k NOT IN (SELECT p_partkey FROM part) GROUP BY k""")
def fk_orphans(spark, sf_dir):
    key = F.col("l_partkey")
    child = read(spark, sf_dir, "lineitem").select(
        F.when(key % 11 == 0, key + 10000000).when(key % 7 != 0, key).alias("l_partkey"))
    return quality.fk_orphans(child, read(spark, sf_dir, "part"), "l_partkey", "p_partkey")


def _sql_profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {table}" for c in columns)


PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(_sql_profile("orders", PROFILED))
def column_profile(spark, sf_dir):
    return quality.column_profile(read(spark, sf_dir, "orders"), PROFILED, exact_distinct=True)


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES))
def row_counts(spark, sf_dir):
    return quality.row_counts({t: read(spark, sf_dir, t) for t in TABLES})
