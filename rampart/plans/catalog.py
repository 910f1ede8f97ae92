"""Queries bound to the driver's tables, each with an equivalent DuckDB oracle.

Every query reads whole driver tables (``{sf_dir}/{table}.parquet``) and
returns a DataFrame whose column names match its oracle SQL.  The driver
tables are clean, so queries first *dirty* them with deterministic integer
expressions that both engines evaluate identically; modulo expressions only
choose which rows are dirtied or copied, never which rows are checked.
Queries that go through files write into a fresh folder under the shared
checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import RuleSpec, TableContract, load_contract
from ..functions.rules import KeyRule, register_key_rule
from ..operators import load as L
from ..operators.constraints import apply_defaults, constraint_check
from ..operators.reshape import add_lineage, align, apply_transforms, filter_columns, rename
from ..operators.reshape import split_address as t_split_address
from ..operators.reshape import split_name as t_split_name
from ..operators.routing import (count_audit, error_message, error_summary, render_audit,
                                 route_errors, route_valid)
from ..operators.validate import INDEX, check_rules, validate
from ..session import hadoop_fs, scratch_path
from ..sources.files import layer_path, read_table, read_versions, write_table
from ..sources.gates import judge_files, quarantine_lines
from . import generate as G
from . import ledger
from .pipeline import CONFIG_ROOT, l0_to_l1, l1_to_target, rcv_to_l0, run_table

# Run parameters shared by the Spark queries and their oracles.
RUN_TS = _dt.datetime(2026, 1, 1, 0, 0, 0)
RUN_TS_TEXT = "2026-01-01 00:00:00"
SOURCE_FILE = "rcv/retail/source/2026/01/01/source.csv"
PROCESS_DATE = _dt.date(2026, 1, 1)


def _t(spark: SparkSession, sf: str, name: str, index: bool = False) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet", "parquet", index=index)


def _c(layer: str, table: str) -> TableContract:
    return load_contract(CONFIG_ROOT, layer, table)


def _blank_to_null(df: DataFrame, cols) -> DataFrame:
    """CSV semantics for in-memory landing rows: an empty field is NULL."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})


# ------------------------------------------------------------ generators
def q_gen_customers(spark, sf):
    return G.gen_customers(_t(spark, sf, "customer"), _t(spark, sf, "nation")).drop("_key")


def q_gen_orders(spark, sf):
    return G.gen_orders(_t(spark, sf, "orders")).drop("_key")


def q_gen_products(spark, sf):
    return G.gen_products(_t(spark, sf, "part")).drop("_key")


def q_gen_province(spark, sf):
    return G.gen_province(_t(spark, sf, "nation")).drop("_key")


_H = "((({k}) % 1000003) * {m} % 1000)"


def _h(k, m):
    return _H.format(k=k, m=m)


SQL_GEN_CUSTOMERS = f"""
SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS id,
  CASE WHEN {_h('c_custkey', 7919)} < 50 THEN ''
       WHEN c_custkey % 3 = 0 THEN fam || ' ' || mid || ' ' || giv
       WHEN c_custkey % 3 = 1 THEN fam || '   ' || giv
       ELSE fam || ' ' || mid || '  ' || giv END AS name,
  CASE WHEN {_h('c_custkey', 7919)} >= 50 AND {_h('c_custkey', 7919)} < 100 THEN strftime(bd, '%d-%m-%Y')
       ELSE strftime(bd, '%Y-%m-%d') END AS birthday,
  CASE WHEN c_custkey % 7 = 1 THEN ', ' || num || ' ' || street || ', ' || n_name || ','
       WHEN c_custkey % 7 = 2 THEN num || ' ' || street || ', , ' || n_name
       ELSE num || ' ' || street || ', ' || n_name END AS address,
  CASE WHEN {_h('c_custkey', 104729)} < 100 THEN CAST(101 + {_h('c_custkey', 104729)} AS VARCHAR)
       ELSE CAST((c_custkey % 1000003) * 13 % 101 AS VARCHAR) END AS kpi,
  c_custkey AS _key
FROM (SELECT c.c_custkey, n.n_name,
        split_part('{G.FAMILY_NAMES}', ' ', CAST(c_custkey % 10 + 1 AS INTEGER)) AS fam,
        split_part('{G.MIDDLE_NAMES}', ' ', CAST(c_custkey % 5 + 1 AS INTEGER)) AS mid,
        split_part('{G.GIVEN_NAMES}', ' ', CAST(c_custkey % 20 + 1 AS INTEGER)) AS giv,
        split_part('{G.STREETS}', '|', CAST(c_custkey % 8 + 1 AS INTEGER)) AS street,
        CAST(c_custkey % 997 + 1 AS VARCHAR) AS num,
        DATE '1960-01-01' + CAST((c_custkey % 1000003) * 37 % 15000 AS INTEGER) AS bd
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""

SQL_GEN_ORDERS = f"""
SELECT 'O' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS id,
  CASE WHEN {_h('o_orderkey', 7919)} < 50 THEN '' ELSE 'C' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS customer_id,
  'P' || lpad(CAST((o_orderkey % 1000003) * 31 % 1999 AS VARCHAR), 8, '0') AS product_id,
  CASE WHEN {_h('o_orderkey', 7919)} >= 50 AND {_h('o_orderkey', 7919)} < 100
         THEN CAST(-({_h('o_orderkey', 7919)} % 6) AS VARCHAR)
       WHEN {_h('o_orderkey', 15485863)} < 10 THEN 'n/a'
       ELSE CAST((o_orderkey % 1000003) * 17 % 50 + 1 AS VARCHAR) END AS quantity,
  CAST(o_totalprice AS VARCHAR) AS price,
  CASE WHEN {_h('o_orderkey', 15485863)} >= 10 AND {_h('o_orderkey', 15485863)} < 20
         THEN strftime(o_orderdate, '%d/%m/%Y')
       ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
  o_orderkey AS _key
FROM orders
"""

SQL_GEN_PRODUCTS = """
SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS id, p_name AS name,
       CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) AS unit_price
FROM part
"""

SQL_GEN_PROVINCE = """
SELECT 'PV' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS id, n_name AS name FROM nation
"""


# ------------------------------------------------------- oracle helpers
def _flagged(v: list[tuple[str, str, str]]) -> dict[str, str]:
    """SQL for rendered violations from (rule, column label, condition)."""
    cond = [f"coalesce(({c}), false)" for _, _, c in v]
    msg = ", ".join(f"CASE WHEN {c} THEN '{r}({col})' END" for (r, col, _), c in zip(v, cond))
    rule = ", ".join(f"CASE WHEN {c} THEN '{r}' END" for (r, _, _), c in zip(v, cond))
    column = ", ".join(f"CASE WHEN {c} THEN '{col}' END" for (_, col, _), c in zip(v, cond))
    n = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in cond)
    summary = " UNION ALL ".join(
        f"SELECT '{r}' AS error_rule, '{col}' AS error_column FROM chk WHERE {c}"
        for (r, col, _), c in zip(v, cond))
    return {"message": f"NULLIF(concat_ws('; ', {msg}), '')",
            "rule": f"concat_ws('; ', {rule})", "column": f"concat_ws('; ', {column})",
            "n": f"({n})", "summary": summary}


def _nn(c):
    return f"{c} IS NULL"


def _dt_int(c):
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS BIGINT) IS NULL"


def _dt_dec(c):
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL"


def _dt_date(c):
    return (f"{c} IS NOT NULL AND (NOT regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}')"
            f" OR TRY_CAST({c} AS DATE) IS NULL)")


def _dt_ts(c):
    return f"{c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL"


def _rng(c, lo, hi):
    return (f"TRY_CAST({c} AS DOUBLE) IS NOT NULL AND NOT (TRY_CAST({c} AS DOUBLE) >= {lo}"
            f" AND TRY_CAST({c} AS DOUBLE) <= {hi})")


# ------------------------------------------------------------ rules
def q_rule_not_null(spark, sf):
    o = _t(spark, sf, "orders", index=True).select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        "_source_file", INDEX)
    out = error_message(check_rules(o, [RuleSpec("not_null", ("o_orderpriority",))]))
    return out.select("o_orderkey", "o_orderpriority", "error_message")


SQL_RULE_NOT_NULL = """
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
  CASE WHEN nullif(o_orderpriority, '4-NOT SPECIFIED') IS NULL THEN 'not_null(o_orderpriority)' END AS error_message
FROM orders
"""


def q_rule_range(spark, sf):
    c = _t(spark, sf, "customer", index=True).select("c_custkey", "c_acctbal", "_source_file", INDEX)
    rule = RuleSpec("range", ("c_acctbal",), (("max", 9000.0), ("min", 0.0)))
    return error_message(check_rules(c, [rule])).select("c_custkey", "c_acctbal", "error_message")


SQL_RULE_RANGE = """
SELECT c_custkey, c_acctbal,
  CASE WHEN c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0 AND c_acctbal <= 9000) THEN 'range(c_acctbal)' END AS error_message
FROM customer
"""


def q_rule_unique(spark, sf):
    d = _t(spark, sf, "documents", index=True).select("doc_id", "text", "_source_file", INDEX)
    return error_message(check_rules(d, [RuleSpec("unique", ("text",))])).select("doc_id", "error_message")


SQL_RULE_UNIQUE = """
SELECT doc_id,
  CASE WHEN text IS NOT NULL AND count(*) OVER (PARTITION BY text) > 1 THEN 'unique(text)' END AS error_message
FROM documents
"""


def q_rule_unique_composite(spark, sf):
    o = _t(spark, sf, "orders", index=True).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderdate", "_source_file", INDEX)
    out = error_message(check_rules(o, [RuleSpec("unique", ("o_custkey", "o_orderdate"))]))
    return out.select("o_orderkey", "o_custkey", "error_message")


SQL_RULE_UNIQUE_COMPOSITE = """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS o_custkey, o_orderdate FROM orders)
SELECT o_orderkey, o_custkey,
  CASE WHEN o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
        AND count(*) OVER (PARTITION BY o_custkey, o_orderdate) > 1
       THEN 'unique(o_custkey,o_orderdate)' END AS error_message
FROM s
"""

register_key_rule("at_most", lambda schema, spec: KeyRule(F.lit(1), F.count, lambda n: n > spec.param("n")))


def q_rule_at_most(spark, sf):
    """A registered rule over a key set, with a unique rule on the same keys."""
    o = _t(spark, sf, "orders", index=True).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("o_custkey"), "_source_file", INDEX)
    rules = [RuleSpec("at_most", ("o_custkey",), (("n", 10),)), RuleSpec("unique", ("o_custkey",))]
    return error_message(check_rules(o, rules)).select("o_orderkey", "o_custkey", "error_message")


SQL_RULE_AT_MOST = """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS o_custkey FROM orders),
c AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM s)
SELECT o_orderkey, o_custkey, CASE WHEN o_custkey IS NULL OR n = 1 THEN NULL WHEN n > 10 THEN 'at_most(o_custkey); unique(o_custkey)'
  ELSE 'unique(o_custkey)' END AS error_message
FROM c
"""

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                 "l_shipdate"]


def q_rule_duplicate_key(spark, sf):
    li = _t(spark, sf, "lineitem", index=True)
    out = check_rules(li, [RuleSpec("duplicate", ("l_orderkey", "l_linenumber"))],
                      order_by=LINEITEM_COLS)
    return error_message(out).select(*LINEITEM_COLS, "error_message")


SQL_RULE_DUPLICATE_KEY = f"""
SELECT {', '.join(LINEITEM_COLS)},
  CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in LINEITEM_COLS)}) > 1
       THEN 'duplicate(l_orderkey,l_linenumber)' END AS error_message
FROM lineitem
"""


def q_rule_duplicate_row(spark, sf):
    """Whole rows, every column: each first line of an order comes twice."""
    li = _t(spark, sf, "lineitem", index=True)
    copies = li.where("l_linenumber = 1").withColumn(INDEX, F.col(INDEX) * 2 + 1)
    both = li.withColumn(INDEX, F.col(INDEX) * 2).unionByName(copies)
    out = validate(both, None, rules=[], whole_row_duplicate=True, check_datatypes=False)
    return error_message(out).select(*LINEITEM_COLS, "error_message")


SQL_RULE_DUPLICATE_ROW = f"""
SELECT {', '.join(LINEITEM_COLS)},
  CASE WHEN row_number() OVER (PARTITION BY {', '.join(LINEITEM_COLS)}) > 1
       THEN 'duplicate({','.join(LINEITEM_COLS)})' END AS error_message
FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
"""


def _dirty_events(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events", index=True)
    return e.select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.col("event_type"))
         .otherwise(F.col("event_id").cast("string")).alias("v_int"),
        F.when(F.col("event_id") % 7 == 0, F.col("event_type"))
         .otherwise(F.col("value").cast("string")).alias("v_dec"),
        F.when(F.col("event_id") % 5 == 0, F.col("props"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("v_date"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("v_ts"),
        "props", "_source_file", INDEX)


SQL_DIRTY_EVENTS = """
SELECT event_id,
  CASE WHEN event_id % 10 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS v_int,
  CASE WHEN event_id % 7 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS v_dec,
  CASE WHEN event_id % 5 = 0 THEN props ELSE strftime(ts, '%Y-%m-%d') END AS v_date,
  CASE WHEN event_id % 3 = 0 THEN event_type ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS v_ts,
  props
FROM events
"""

EVENTS_TYPES = [("v_int", "int"), ("v_dec", "decimal"), ("v_date", "date"), ("v_ts", "datetime"),
                ("props", "string")]


def q_rule_datatype(spark, sf):
    rules = [RuleSpec("datatype", (c,), (("type", t),)) for c, t in EVENTS_TYPES]
    return error_message(check_rules(_dirty_events(spark, sf), rules)).select("event_id", "error_message")


_ev = _flagged([("datatype", "v_int", _dt_int("v_int")), ("datatype", "v_dec", _dt_dec("v_dec")),
                ("datatype", "v_date", _dt_date("v_date")), ("datatype", "v_ts", _dt_ts("v_ts")),
                ("datatype", "props", "false")])
SQL_RULE_DATATYPE = f"""
WITH chk AS ({SQL_DIRTY_EVENTS})
SELECT event_id, {_ev['message']} AS error_message FROM chk
"""


def _dirty_order_dates(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders", index=True)
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "dd-MM-yyyy"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d_text"),
        "_source_file", INDEX)


SQL_DIRTY_ORDER_DATES = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d_text
FROM orders
"""


def q_rule_format(spark, sf):
    rule = RuleSpec("format", ("d_text",), (("format", "yyyy-MM-dd"),))
    return error_message(check_rules(_dirty_order_dates(spark, sf), [rule])).select(
        "o_orderkey", "d_text", "error_message")


SQL_RULE_FORMAT = f"""
WITH s AS ({SQL_DIRTY_ORDER_DATES})
SELECT o_orderkey, d_text, CASE WHEN {_dt_date('d_text')} THEN 'format(d_text)' END AS error_message FROM s
"""


# ------------------------------------------- full rule set and routing
ORDER_L0_COLS = ["id", "customer_id", "product_id", "quantity", "price", "order_date",
                 "source_file", "process_date"]
CUSTOMER_L0_COLS = ["id", "name", "birthday", "address", "kpi", "source_file", "process_date"]


def _l0_orders(spark, sf) -> DataFrame:
    """Generated orders + lineage as text, with whole-row copies (key % 50 = 0)
    and same-id copies with another quantity (key % 77 = 0) appended;
    ``_source_index`` = key * 3 + copy number."""
    g = G.gen_orders(_t(spark, sf, "orders"))
    base = _blank_to_null(g, ["customer_id"]).withColumns(
        {"source_file": F.lit(SOURCE_FILE), "process_date": F.lit(RUN_TS_TEXT)})
    k = F.col("_key")
    copies = [base.withColumn(INDEX, k * 3),
              base.where(k % 50 == 0).withColumn(INDEX, k * 3 + 1),
              base.where(k % 77 == 0).withColumns({"quantity": F.lit("7"), INDEX: k * 3 + 2})]
    src = copies[0].unionByName(copies[1]).unionByName(copies[2])
    return src.select(*ORDER_L0_COLS, INDEX)


SQL_L0_ORDERS = f"""
WITH g AS ({SQL_GEN_ORDERS}),
b AS (SELECT id, nullif(customer_id, '') AS customer_id, product_id, quantity, price, order_date,
             '{SOURCE_FILE}' AS source_file, '{RUN_TS_TEXT}' AS process_date, _key FROM g)
SELECT id, customer_id, product_id, quantity, price, order_date, source_file, process_date, _key * 3 AS _source_index FROM b
UNION ALL SELECT id, customer_id, product_id, quantity, price, order_date, source_file, process_date, _key * 3 + 1 FROM b WHERE _key % 50 = 0
UNION ALL SELECT id, customer_id, product_id, '7', price, order_date, source_file, process_date, _key * 3 + 2 FROM b WHERE _key % 77 = 0
"""

_ALL8 = ", ".join(ORDER_L0_COLS)
_orders_v = _flagged(
    [("duplicate", ",".join(ORDER_L0_COLS), "rn_all > 1"),
     ("datatype", "quantity", _dt_int("quantity")), ("datatype", "price", _dt_dec("price")),
     ("datatype", "order_date", _dt_ts("order_date")), ("datatype", "process_date", _dt_ts("process_date"))]
    + [("not_null", c, _nn(c)) for c in ORDER_L0_COLS]
    + [("range", "quantity", _rng("quantity", 0, 9999)), ("range", "price", _rng("price", 0, 9999999)),
       ("duplicate", "id", "rn_id > 1"),
       ("unique", "customer_id,product_id",
        "customer_id IS NOT NULL AND product_id IS NOT NULL AND n_cp > 1")])


def q_validate_all_rules(spark, sf):
    checked = validate(_l0_orders(spark, sf), _c("l0", "orders"))
    return error_message(checked).select(INDEX, "id", "error_message")


SQL_VALIDATE_ALL_RULES = f"""
WITH s AS ({SQL_L0_ORDERS}),
chk AS (SELECT *, row_number() OVER (PARTITION BY {_ALL8} ORDER BY _source_index) AS rn_all,
               row_number() OVER (PARTITION BY id ORDER BY _source_index) AS rn_id,
               count(*) OVER (PARTITION BY customer_id, product_id) AS n_cp FROM s)
SELECT _source_index, id, {_orders_v['message']} AS error_message FROM chk
"""


def _l0_customers(spark, sf) -> DataFrame:
    """Generated customers + lineage as text, with whole-row copies
    (key % 60 = 0) and same-id copies with kpi 50 (key % 40 = 0)."""
    g = G.gen_customers(_t(spark, sf, "customer"), _t(spark, sf, "nation"))
    base = _blank_to_null(g, ["name"]).withColumns(
        {"source_file": F.lit(SOURCE_FILE), "process_date": F.lit(RUN_TS_TEXT)})
    k = F.col("_key")
    copies = [base.withColumn(INDEX, k * 3),
              base.where(k % 60 == 0).withColumn(INDEX, k * 3 + 1),
              base.where(k % 40 == 0).withColumns({"kpi": F.lit("50"), INDEX: k * 3 + 2})]
    src = copies[0].unionByName(copies[1]).unionByName(copies[2])
    return src.select(*CUSTOMER_L0_COLS, INDEX)


SQL_L0_CUSTOMERS = f"""
WITH g AS ({SQL_GEN_CUSTOMERS}),
b AS (SELECT id, nullif(name, '') AS name, birthday, address, kpi,
             '{SOURCE_FILE}' AS source_file, '{RUN_TS_TEXT}' AS process_date, _key FROM g)
SELECT id, name, birthday, address, kpi, source_file, process_date, _key * 3 AS _source_index FROM b
UNION ALL SELECT id, name, birthday, address, kpi, source_file, process_date, _key * 3 + 1 FROM b WHERE _key % 60 = 0
UNION ALL SELECT id, name, birthday, address, '50', source_file, process_date, _key * 3 + 2 FROM b WHERE _key % 40 = 0
"""

_ALL7 = ", ".join(CUSTOMER_L0_COLS)
_cust_v = _flagged(
    [("duplicate", ",".join(CUSTOMER_L0_COLS), "rn_all > 1"),
     ("datatype", "birthday", _dt_date("birthday")), ("datatype", "kpi", _dt_dec("kpi")),
     ("datatype", "process_date", _dt_ts("process_date"))]
    + [("not_null", c, _nn(c)) for c in CUSTOMER_L0_COLS]
    + [("range", "kpi", _rng("kpi", 0, 100)), ("duplicate", "id", "rn_id > 1")])

SQL_CUSTOMERS_CHK = f"""
WITH s AS ({SQL_L0_CUSTOMERS}),
chk AS (SELECT *, row_number() OVER (PARTITION BY {_ALL7} ORDER BY _source_index) AS rn_all,
               row_number() OVER (PARTITION BY id ORDER BY _source_index) AS rn_id FROM s)
"""


def _checked_customers(spark, sf) -> DataFrame:
    return validate(_l0_customers(spark, sf), _c("l0", "customers"))


def q_route_valid(spark, sf):
    return route_valid(_checked_customers(spark, sf))


SQL_ROUTE_VALID = f"{SQL_CUSTOMERS_CHK} SELECT {_ALL7} FROM chk WHERE {_cust_v['n']} = 0"


def q_route_errors(spark, sf):
    return route_errors(_checked_customers(spark, sf)).select(*CUSTOMER_L0_COLS, INDEX)


SQL_ROUTE_ERRORS = f"{SQL_CUSTOMERS_CHK} SELECT {_ALL7}, _source_index FROM chk WHERE {_cust_v['n']} > 0"


def q_audit_enrich(spark, sf):
    return render_audit(route_errors(_checked_customers(spark, sf)))


SQL_AUDIT_ENRICH = f"""{SQL_CUSTOMERS_CHK}
SELECT {_ALL7}, _source_index, 'validation' AS error_type, {_cust_v['rule']} AS error_rule,
       {_cust_v['column']} AS error_column, {_cust_v['message']} AS error_message
FROM chk WHERE {_cust_v['n']} > 0
"""


def q_error_summary(spark, sf):
    return error_summary(_checked_customers(spark, sf))


SQL_ERROR_SUMMARY = f"""{SQL_CUSTOMERS_CHK}
SELECT error_rule, error_column, count(*) AS n_rows FROM ({_cust_v['summary']}) v GROUP BY error_rule, error_column
"""


def q_count_audit(spark, sf):
    return count_audit(_checked_customers(spark, sf))


SQL_COUNT_AUDIT = f"""{SQL_CUSTOMERS_CHK}
SELECT count(*) AS n_in, count(*) FILTER (WHERE {_cust_v['n']} = 0) AS n_valid,
       count(*) FILTER (WHERE {_cust_v['n']} > 0) AS n_error,
       CAST(coalesce(sum({_cust_v['n']}), 0) AS BIGINT) AS n_violations
FROM chk
"""


# ------------------------------------------------------------ reshaping
def _names(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    k = F.col("p_partkey") % 6
    raw = (F.when(k == 0, F.col("p_name"))
           .when(k == 1, F.concat(F.lit("  "), F.col("p_name"), F.lit("  ")))
           .when(k == 2, F.regexp_replace("p_name", " ", "   "))
           .when(k == 3, F.lit(""))
           .when(k == 4, F.lit(None).cast("string"))
           .otherwise(F.concat_ws(" ", "p_name", "p_brand")))
    return p.select("p_partkey", raw.alias("full_name"))


SQL_NAMES = """
SELECT p_partkey,
  CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN '  ' || p_name || '  '
       WHEN 2 THEN replace(p_name, ' ', '   ') WHEN 3 THEN '' WHEN 4 THEN NULL
       ELSE p_name || ' ' || p_brand END AS full_name
FROM part
"""

_NORM = "nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g')), '')"


def _sql_split_name(c: str) -> str:
    n = _NORM.format(c=c)
    return (f"CASE WHEN {n} IS NOT NULL THEN regexp_extract({n}, '([^ ]+)$', 1) END AS first_name, "
            f"CASE WHEN {n} LIKE '% %' THEN regexp_extract({n}, '^(.*) [^ ]+$', 1) END AS last_name")


def _sql_parts(c: str) -> str:
    return (f"list_filter(list_transform(string_split({c}, ','), "
            f"lambda p: trim(regexp_replace(p, '\\s+', ' ', 'g'))), lambda p: p <> '')")


def _sql_split_address(c: str, addr: str = "address", prov: str = "address_province") -> str:
    parts = _sql_parts(c)
    return (f"CASE WHEN {c} IS NOT NULL AND len({parts}) > 0 THEN array_to_string({parts}, ', ') END AS {addr}, "
            f"CASE WHEN len({parts}) > 1 THEN ({parts})[-1] END AS {prov}")


def q_split_name(spark, sf):
    return t_split_name(_names(spark, sf), [{"from": "full_name", "to": ["first_name", "last_name"]}])


SQL_SPLIT_NAME = f"WITH s AS ({SQL_NAMES}) SELECT p_partkey, full_name, {_sql_split_name('full_name')} FROM s"


def _addresses(spark, sf) -> DataFrame:
    c, n, r = _t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
         .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    num = (F.col("c_custkey") % 500 + 1).cast("string")
    k = F.col("c_custkey") % 7
    street = F.concat(num, F.lit(" Main Street"))
    raw = (F.when(k == 0, F.concat_ws(", ", street, "n_name", "r_name"))
           .when(k == 1, F.concat(F.lit(", "), street, F.lit(", "), F.col("n_name"), F.lit(",")))
           .when(k == 2, F.concat(street, F.lit(", , "), F.col("n_name")))
           .when(k == 3, F.concat(num, F.lit("   Main   Street")))
           .when(k == 4, F.col("n_name"))
           .when(k == 5, F.lit("  ,  "))
           .otherwise(F.lit(None).cast("string")))
    return j.select("c_custkey", raw.alias("raw_address"))


SQL_ADDRESSES = """
SELECT c_custkey,
  CASE c_custkey % 7
    WHEN 0 THEN CAST(c_custkey % 500 + 1 AS VARCHAR) || ' Main Street' || ', ' || n_name || ', ' || r_name
    WHEN 1 THEN ', ' || CAST(c_custkey % 500 + 1 AS VARCHAR) || ' Main Street' || ', ' || n_name || ','
    WHEN 2 THEN CAST(c_custkey % 500 + 1 AS VARCHAR) || ' Main Street' || ', , ' || n_name
    WHEN 3 THEN CAST(c_custkey % 500 + 1 AS VARCHAR) || '   Main   Street'
    WHEN 4 THEN n_name
    WHEN 5 THEN '  ,  '
    ELSE NULL END AS raw_address
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
     LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def q_split_address(spark, sf):
    return t_split_address(_addresses(spark, sf), [{"from": "raw_address", "to": ["address", "address_province"]}])


SQL_SPLIT_ADDRESS = (f"WITH s AS ({SQL_ADDRESSES}) SELECT c_custkey, raw_address, "
                     f"{_sql_split_address('raw_address')} FROM s")


def q_rename_columns(spark, sf):
    return rename(_t(spark, sf, "customer"), [{"from": "c_custkey", "to": "customer_id"},
                                              {"from": "c_name", "to": "customer_name"}])


SQL_RENAME_COLUMNS = ("SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, "
                      "c_mktsegment FROM customer")


def q_select_columns(spark, sf):
    return filter_columns(_t(spark, sf, "customer"), [{"output": ["c_name", "c_custkey", "c_acctbal"]}])


SQL_SELECT_COLUMNS = "SELECT c_name, c_custkey, c_acctbal FROM customer"

ALIGN_TARGET = TableContract.from_dict({"table_name": "customer_aligned", "columns": [
    {"name": "c_custkey", "type": "string"}, {"name": "c_name", "type": "string"},
    {"name": "c_acctbal", "type": "decimal"}, {"name": "c_nationkey", "type": "int"},
    {"name": "first_name", "type": "string"}]})


def q_align_schema(spark, sf):
    return align(_t(spark, sf, "customer"), ALIGN_TARGET)


SQL_ALIGN_SCHEMA = ("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal, "
                    "CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS VARCHAR) AS first_name FROM customer")


def q_add_lineage(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name")
    return add_lineage(c, [{"name": "process_date"}, {"name": "source_file"}], RUN_TS, SOURCE_FILE)


SQL_ADD_LINEAGE = (f"SELECT c_custkey, c_name, TIMESTAMP '{RUN_TS_TEXT}' AS process_date, "
                   f"'{SOURCE_FILE}' AS source_file FROM customer")

L1_CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "birthday", "address", "address_province",
                    "kpi", "process_date", "source_file"]


def q_transform_pipeline(spark, sf):
    df = _l0_customers(spark, sf).drop(INDEX)
    return apply_transforms(df, _c("l0", "customers"))


SQL_TRANSFORM_PIPELINE = f"""
WITH s AS ({SQL_L0_CUSTOMERS})
SELECT id AS customer_id, {_sql_split_name('name')}, birthday,
       {_sql_split_address('address')}, kpi, process_date, source_file
FROM s
"""

EVENTS_CAST = TableContract.from_dict({"table_name": "events_typed", "columns": [
    {"name": "event_id", "type": "int"}, {"name": "v_int", "type": "int"},
    {"name": "v_dec", "type": "decimal"}, {"name": "v_date", "type": "date"},
    {"name": "v_ts", "type": "datetime"}]})


def q_cast_types(spark, sf):
    return align(_dirty_events(spark, sf), EVENTS_CAST)


SQL_CAST_TYPES = f"""
WITH s AS ({SQL_DIRTY_EVENTS})
SELECT event_id, TRY_CAST(v_int AS BIGINT) AS v_int, TRY_CAST(v_dec AS DOUBLE) AS v_dec,
  CASE WHEN regexp_full_match(v_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(v_date AS DATE) END AS v_date,
  TRY_CAST(v_ts AS TIMESTAMP) AS v_ts
FROM s
"""

DATES_CAST = TableContract.from_dict({"table_name": "orders_dates", "columns": [
    {"name": "o_orderkey", "type": "int"}, {"name": "d_text", "type": "string"},
    {"name": "d", "type": "date", "format": "YYYY-MM-DD"}]})


def q_cast_date_format(spark, sf):
    return align(_dirty_order_dates(spark, sf).withColumn("d", F.col("d_text")), DATES_CAST)


SQL_CAST_DATE_FORMAT = f"""
WITH s AS ({SQL_DIRTY_ORDER_DATES})
SELECT o_orderkey, d_text,
  CASE WHEN regexp_full_match(d_text, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(d_text AS DATE) END AS d
FROM s
"""


# ---------------------------------------------------------------- loads
CUSTOMER_TABLE = TableContract.from_dict({
    "table_name": "customer_serving", "columns": [
        {"name": "c_custkey", "type": "int", "primary_key": True},
        {"name": "c_name", "type": "string", "db_type": "VARCHAR", "max_length": 25, "not_null": True},
        {"name": "c_nationkey", "type": "int"},
        {"name": "c_acctbal", "type": "double"},
        {"name": "c_mktsegment", "type": "string"}],
    "load_database": {"load_strategy": "upsert", "primary_key": "c_custkey"}})

SQL_CUSTOMER_TYPED = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                      "c_mktsegment FROM customer")


def _customer_target(spark, sf, name) -> tuple[str, DataFrame]:
    root = scratch_path(spark, name)
    c = _t(spark, sf, "customer")
    L.create_target(spark, CUSTOMER_TABLE, root)
    L.append(spark, c.where(F.col("c_custkey") % 3 != 0), CUSTOMER_TABLE, root)
    return root, c


def q_load_append(spark, sf):
    root, c = _customer_target(spark, sf, "load_append")
    L.append(spark, c.where(F.col("c_custkey") % 3 == 0), CUSTOMER_TABLE, root)
    return L.read_target(spark, root, CUSTOMER_TABLE)


SQL_LOAD_APPEND = SQL_CUSTOMER_TYPED


def _incoming(c: DataFrame) -> DataFrame:
    """Every row that the target lacks and half of those it has, changed."""
    return c.where((F.col("c_custkey") % 2 == 0) | (F.col("c_custkey") % 3 == 0)).withColumn("c_acctbal", F.col("c_acctbal") + 1)


def q_load_append_new_only(spark, sf):
    root, c = _customer_target(spark, sf, "load_append_new")
    L.append(spark, _incoming(c), CUSTOMER_TABLE, root, on_conflict="ignore")
    return L.read_target(spark, root, CUSTOMER_TABLE)


SQL_LOAD_APPEND_NEW_ONLY = f"""
SELECT * FROM ({SQL_CUSTOMER_TYPED}) WHERE c_custkey % 3 <> 0
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
FROM ({SQL_CUSTOMER_TYPED}) WHERE c_custkey % 3 = 0
"""


def q_load_replace(spark, sf):
    root, c = _customer_target(spark, sf, "load_replace")
    L.replace(spark, c.withColumn("c_acctbal", F.col("c_acctbal") + 1), CUSTOMER_TABLE, root)
    return L.read_target(spark, root, CUSTOMER_TABLE)


SQL_LOAD_REPLACE = f"""
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
FROM ({SQL_CUSTOMER_TYPED})
"""


def q_load_upsert(spark, sf):
    root, c = _customer_target(spark, sf, "load_upsert")
    L.upsert(spark, _incoming(c), CUSTOMER_TABLE, root)
    return L.read_target(spark, root, CUSTOMER_TABLE)


SQL_LOAD_UPSERT = f"""
SELECT * FROM ({SQL_CUSTOMER_TYPED}) WHERE c_custkey % 3 <> 0 AND c_custkey % 2 <> 0
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
FROM ({SQL_CUSTOMER_TYPED}) WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0
"""

UNIQUE_TABLE = TableContract.from_dict({
    "table_name": "customer_unique", "columns": [
        {"name": "c_custkey", "type": "int", "primary_key": True},
        {"name": "c_name", "type": "string", "unique": True},
        {"name": "c_acctbal", "type": "double"}],
    "load_database": {"load_strategy": "upsert", "primary_key": "c_custkey"}})


def q_load_unique_conflict(spark, sf):
    """Names that stored rows have, appended and upserted under other keys: refused, unless the row that
    has the name is replaced by the same load."""
    root = scratch_path(spark, "load_unique")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    of_next = F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") + 1).cast("string"), 9, "0"))
    L.create_target(spark, UNIQUE_TABLE, root)
    L.append(spark, c.where("c_custkey % 3 <> 0"), UNIQUE_TABLE, root)
    new = c.where("c_custkey % 3 = 0").withColumn("c_name", F.when(F.col("c_custkey") % 4 == 0, of_next).otherwise(F.col("c_name")))
    L.append(spark, new, UNIQUE_TABLE, root, rejects=f"{root}-append")
    # the next key's row (mod 3: 2) frees its name only where it is loaded, too, under another one
    moved = (c.where("c_custkey % 3 = 1").withColumn("c_name", F.when(F.col("c_custkey") % 2 == 0, of_next).otherwise(F.col("c_name")))
             .unionByName(c.where("c_custkey % 15 = 8").withColumn("c_name", F.concat("c_name", F.lit(" moved")))))
    L.upsert(spark, moved.withColumn("c_acctbal", F.col("c_acctbal") + 1), UNIQUE_TABLE, root, rejects=f"{root}-upsert")
    out = L.read_target(spark, root, UNIQUE_TABLE).withColumn("outcome", F.lit("stored"))
    for name in ("append", "upsert"):
        refused = spark.read.parquet(f"{root}-{name}").select("c_custkey", "c_name", "c_acctbal", F.concat(F.lit(f"{name}: "), "error_message").alias("outcome"))
        out = out.unionByName(refused)
    return out


SQL_LOAD_UNIQUE_CONFLICT = """
WITH c AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0') AS of_next FROM customer),
first AS (SELECT k, name, bal FROM c WHERE k % 3 <> 0),
new AS (SELECT k, CASE WHEN k % 4 = 0 THEN of_next ELSE name END AS name, bal FROM c WHERE k % 3 = 0),
refused_append AS (SELECT * FROM new WHERE name IN (SELECT name FROM first)),
held AS (SELECT * FROM first UNION ALL SELECT * FROM new WHERE name NOT IN (SELECT name FROM first)),
moved AS (SELECT k, CASE WHEN k % 3 = 1 AND k % 2 = 0 THEN of_next WHEN k % 3 = 2 THEN name || ' moved' ELSE name END AS name, bal + 1 AS bal
          FROM c WHERE k % 3 = 1 OR k % 15 = 8),
refused_upsert AS (SELECT * FROM moved WHERE name IN (SELECT name FROM held WHERE k NOT IN (SELECT k FROM moved))),
loaded AS (SELECT * FROM moved WHERE k NOT IN (SELECT k FROM refused_upsert))
SELECT k AS c_custkey, name AS c_name, bal AS c_acctbal, 'stored' AS outcome FROM loaded
UNION ALL SELECT k, name, bal, 'stored' FROM held WHERE k NOT IN (SELECT k FROM loaded)
UNION ALL SELECT k, name, bal, 'append: unique(c_name)' FROM refused_append
UNION ALL SELECT k, name, bal, 'upsert: unique(c_name)' FROM refused_upsert
"""

ORDER_TABLE = TableContract.from_dict({
    "table_name": "order_serving", "columns": [
        {"name": "o_custkey", "type": "int", "primary_key": True},
        {"name": "o_orderkey", "type": "int", "primary_key": True},
        {"name": "o_orderpriority", "type": "string", "not_null": True}],
    "load_database": {"load_strategy": "upsert", "primary_key": ["o_custkey", "o_orderkey"]}})


def q_load_upsert_composite(spark, sf):
    """A key of two columns, neither unique by itself for the customer part."""
    root = scratch_path(spark, "load_composite")
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    L.create_target(spark, ORDER_TABLE, root)
    L.load(spark, o.where("o_orderkey % 3 <> 0"), ORDER_TABLE, root)
    later = o.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").withColumn("o_orderpriority", F.lit("CHANGED"))
    L.load(spark, later, ORDER_TABLE, root)
    return L.read_target(spark, root, ORDER_TABLE)


SQL_LOAD_UPSERT_COMPOSITE = """
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

SUPPLIER_TABLE = TableContract.from_dict({
    "table_name": "supplier_serving", "columns": [
        {"name": "s_suppkey", "type": "int", "primary_key": True},
        {"name": "s_name", "type": "string", "not_null": True},
        {"name": "s_nationkey", "type": "int"}, {"name": "s_acctbal", "type": "double"}],
    "load_database": {"load_strategy": "truncate_and_insert", "primary_key": "s_suppkey"}})


def q_load_dispatch(spark, sf):
    """Strategy chosen by the contract: truncate_and_insert twice (second wins)."""
    root = scratch_path(spark, "load_dispatch")
    s = _t(spark, sf, "supplier")
    L.create_target(spark, SUPPLIER_TABLE, root)
    L.load(spark, s.withColumn("s_acctbal", F.lit(0.0)), SUPPLIER_TABLE, root)
    L.load(spark, s, SUPPLIER_TABLE, root)
    return L.read_target(spark, root, SUPPLIER_TABLE)


SQL_LOAD_DISPATCH = ("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal "
                     "FROM supplier")

CONSTRAINT_TABLE = TableContract.from_dict({
    "table_name": "customer_checked", "columns": [
        {"name": "c_custkey", "type": "int", "primary_key": True},
        {"name": "c_name", "type": "string", "db_type": "VARCHAR", "max_length": 25, "unique": True},
        {"name": "c_acctbal", "type": "double", "db_type": "NUMERIC", "precision": 6, "scale": 2,
         "range": [0, 9000]},
        {"name": "c_mktsegment", "type": "string", "db_type": "VARCHAR", "max_length": 9,
         "not_null": True}]})


def q_constraint_check(spark, sf):
    c = _t(spark, sf, "customer", index=True)
    c = c.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    out = error_message(constraint_check(c.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment",
                                                  "_source_file", INDEX), CONSTRAINT_TABLE))
    return out.select("c_custkey", "error_message")


_con_v = _flagged([
    ("not_null", "c_custkey", "c_custkey IS NULL"),
    ("max_length", "c_name", "length(c_name) > 25"),
    ("check", "c_acctbal", "c_acctbal IS NOT NULL AND NOT (c_acctbal >= 0 AND c_acctbal <= 9000)"),
    ("numeric", "c_acctbal", "c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(6,2)) IS NULL"),
    ("not_null", "c_mktsegment", "c_mktsegment IS NULL"),
    ("max_length", "c_mktsegment", "length(c_mktsegment) > 9"),
    ("unique", "c_custkey", "c_custkey IS NOT NULL AND n_key > 1"),
    ("unique", "c_name", "c_name IS NOT NULL AND n_name > 1")])

SQL_CONSTRAINT_CHECK = f"""
WITH s AS (SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer),
chk AS (SELECT *, count(*) OVER (PARTITION BY c_custkey) AS n_key, count(*) OVER (PARTITION BY c_name) AS n_name FROM s)
SELECT c_custkey, {_con_v['message']} AS error_message FROM chk
"""

DEFAULTS_TABLE = TableContract.from_dict({
    "table_name": "customer_defaults", "columns": [
        {"name": "c_custkey", "type": "int"},
        {"name": "c_mktsegment", "type": "string", "default": "UNKNOWN"},
        {"name": "status", "type": "string", "default": "active"}]})


def q_constraint_default(spark, sf):
    c = _t(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return align(apply_defaults(c, DEFAULTS_TABLE), DEFAULTS_TABLE)


SQL_CONSTRAINT_DEFAULT = ("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment, "
                          "'active' AS status FROM customer")


def q_run_ledger_latest(spark, sf):
    e = _t(spark, sf, "events").select(
        F.lit("events").alias("table_name"), F.col("user_id").alias("run_id"),
        F.col("event_type").alias("status"), F.col("ts").alias("started_at"),
        F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("ended_at"), "event_id")
    out = ledger.latest(e, keys=("table_name", "run_id"), tie="event_id")  # every fifth event is still open
    return out.select("run_id", "status", "started_at", "ended_at", "event_id", "n_events")


SQL_RUN_LEDGER_LATEST = """
SELECT run_id, status, started_at, ended_at, event_id, n_events FROM (
  SELECT user_id AS run_id, event_type AS status, ts AS started_at, CASE WHEN event_id % 5 <> 0 THEN ts END AS ended_at, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n_events
  FROM events) WHERE rn = 1
"""


# ------------------------------------------------------ scans and sinks
CUSTOMER_TEXT = TableContract.from_dict({"table_name": "customer", "columns": [
    {"name": "c_custkey", "type": "int"}, {"name": "c_name", "type": "string"},
    {"name": "c_nationkey", "type": "int"}, {"name": "c_acctbal", "type": "decimal"},
    {"name": "c_mktsegment", "type": "string"}]})


def q_scan_parquet(spark, sf):
    return read_table(spark, f"{sf}/customer.parquet", "parquet")


SQL_SCAN_PARQUET = "SELECT * FROM customer"

ORDERS_NOW = TableContract.from_dict({"table_name": "orders", "columns": [
    {"name": "o_orderkey", "type": "int"}, {"name": "o_custkey", "type": "int"}, {"name": "o_totalprice", "type": "decimal"},
    {"name": "o_orderdate", "type": "date", "format": "YYYY-MM-DD"}, {"name": "o_orderpriority", "type": "string"}]})


def q_scan_versions(spark, sf):
    """Days written under three contracts: keys as text, dates as text and another column; a
    narrower key and no priority; the present one."""
    root, o = scratch_path(spark, "scan_versions"), _t(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    written = [o.select(F.col("o_orderkey").cast("string"), F.when(F.col("o_custkey") % 10 == 0, "unknown").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
                        "o_totalprice", "o_orderstatus", day.alias("o_orderdate"), "o_orderpriority"),
               o.select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("date")),
               align(o.withColumn("o_orderdate", day), ORDERS_NOW)]
    for k, rows in enumerate(written):
        write_table(rows.where(F.col("o_orderkey").cast("long") % 3 == k), f"{root}/{k}", "parquet")
    return read_versions(spark, [f"{root}/{k}" for k in range(3)], ORDERS_NOW)


SQL_SCAN_VERSIONS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 OR o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS o_orderpriority
FROM orders"""

LANDING_CUSTOMERS = _c("rcv", "customers")


def q_scan_csv(spark, sf):
    path = scratch_path(spark, "scan_csv")
    write_table(q_gen_customers(spark, sf), path, "csv")
    return read_table(spark, path, "csv", contract=LANDING_CUSTOMERS, index=True).drop("_source_file", INDEX)


SQL_SCAN_CSV = (f"SELECT nullif(id, '') AS id, nullif(name, '') AS name, birthday, address, kpi "
                f"FROM ({SQL_GEN_CUSTOMERS})")


NOTES_TEXT = TableContract.from_dict({"table_name": "notes", "columns": [
    {"name": n, "type": "string"} for n in ("doc_id", "text", "lang", "source")]})


def q_scan_csv_multiline(spark, sf):
    """Whole document texts, with line breaks, quotes and commas, through CSV."""
    path = scratch_path(spark, "multiline")
    d = _t(spark, sf, "documents")
    note = F.concat(F.lit('first line, "quoted"\n\n'), F.replace("text", F.lit(". "), F.lit('.\n"')))
    write_table(d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(note).alias("text"), "lang", "source"), path, "csv")
    out = read_table(spark, path, "csv", contract=NOTES_TEXT, multiline=True, index=True)
    dense = out.agg((F.count_distinct(INDEX) == F.max(INDEX) + 1).alias("dense"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha")).join(F.broadcast(dense), F.lit(True))


SQL_SCAN_CSV_MULTILINE = """
SELECT doc_id, lang, source, length(t) AS n, sha256(t) AS sha, true AS dense
FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN text ELSE 'first line, "quoted"' || chr(10) || chr(10) || replace(text, '. ', '.' || chr(10) || '"') END AS t FROM documents)
"""


def q_source_index_csv(spark, sf):
    """The index that a CSV scan attaches: one file a nation, in path order."""
    path = scratch_path(spark, "source_index")
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey") \
        .write.partitionBy("c_nationkey").option("header", True).csv(path)
    two = TableContract.from_dict({"table_name": "c", "columns": [{"name": "c_custkey", "type": "string"}, {"name": "c_name", "type": "string"}]})
    out = read_table(spark, path, "csv", contract=two, index=True)
    label = F.regexp_extract("_source_file", r"/(c_nationkey=\d+)/", 1)
    return out.select("c_custkey", "c_name", label.alias("file"), F.col(INDEX).alias("source_index"))


SQL_SOURCE_INDEX_CSV = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, 'c_nationkey=' || CAST(c_nationkey AS VARCHAR) AS file,
  row_number() OVER (ORDER BY 'c_nationkey=' || CAST(c_nationkey AS VARCHAR) || '/', c_custkey) - 1 AS source_index
FROM customer
"""


def q_sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "sink_csv")
    write_table(_t(spark, sf, "customer"), path, "csv")
    return align(read_table(spark, path, "csv", contract=CUSTOMER_TEXT), CUSTOMER_TEXT)


def q_sink_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "sink_parquet")
    write_table(_t(spark, sf, "customer"), path, "parquet")
    return read_table(spark, path, "parquet")


def q_jdbc_roundtrip(spark, sf):
    from ..sources.jdbc import read_jdbc, write_jdbc

    url = f"jdbc:derby:memory:{scratch_path(spark, 'db').rsplit('/', 1)[-1]};create=true"
    write_jdbc(_t(spark, sf, "customer"), url, "CUSTOMER", mode="overwrite", batch_size=10000,
               num_partitions=4, driver="org.apache.derby.jdbc.EmbeddedDriver")
    df = read_jdbc(spark, url, "CUSTOMER", driver="org.apache.derby.jdbc.EmbeddedDriver")
    return df.toDF(*[c.lower() for c in df.columns])


# ---------------------------------------------------------------- gates
GATE_CONTRACT = TableContract.from_dict({
    "table_name": "customer", "columns": [{"name": c, "type": "string"} for c in
                                          ("c_custkey", "c_name", "c_acctbal", "c_mktsegment")],
    "validation": {"validate_file": True, "validate_schema": True}})


def _landing(spark, sf) -> str:
    """A landing folder built from ``customer``: accepted files per nation, a
    reordered header per nation, invalid UTF-8 per nation, plus a header-only,
    a blank-first-line and a zero-byte file and one expected file missing."""
    root = scratch_path(spark, "landing")
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_mktsegment", "c_nationkey")
    opts = {"header": True}
    c.write.partitionBy("c_nationkey").options(**opts).csv(f"{root}/good")
    c.select("c_name", "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey") \
        .write.partitionBy("c_nationkey").options(**opts).csv(f"{root}/mismatch")
    bad = F.concat_ws(",", "c_custkey", F.concat("c_name", F.unhex(F.lit("FF")).cast("string")),
                      "c_acctbal", "c_mktsegment")
    c.select(bad.alias("value"), "c_nationkey").write.partitionBy("c_nationkey").text(f"{root}/badutf8")
    header = ",".join(GATE_CONTRACT.column_names)
    for name, body in (("headeronly/part.csv", header + "\n"),
                       ("blankfirst/part.csv", "\n" + header + "\n1,x,1.0,AUTO\n"),
                       ("zerobyte/part.csv", "")):
        fs, p = hadoop_fs(spark, f"{root}/{name}")
        out = fs.create(p, True)
        out.write(bytearray(body, "utf-8"))
        out.close()
    return root


def _label(path_col: str):
    return F.regexp_extract(F.col(path_col), r"/landing-[0-9a-f]+/([^/]+(?:/c_nationkey=\d+)?)", 1)


def _gate(spark, sf, checks) -> DataFrame:
    root = _landing(spark, sf)
    v = judge_files(spark, [root, f"{root}/missing/part.csv"], GATE_CONTRACT, checks=checks)
    return v.select(_label("file_path").alias("label"), "status", _reason().alias("reason")).distinct()


def _reason():
    """A reason with the file's label for its path; a header that is no text is left out."""
    named = F.regexp_replace("reason", r"\S*/landing-[0-9a-f]+/([^/]+(?:/c_nationkey=\d+)?)\S*", "$1")
    return F.regexp_replace(named, r"got \[.*Customer#(?s:.*)\]$", "got [data]")


def q_file_gate(spark, sf):
    return _gate(spark, sf, ("validate_file", "validate_schema"))


_NATIONS = "SELECT DISTINCT c_nationkey FROM customer"
_MISMATCH = "Schema mismatch. Expected [''c_custkey'', ''c_name'', ''c_acctbal'', ''c_mktsegment''], got "


def _sql_gate(verdicts: dict[str, tuple[str, str | None]]) -> str:
    """One row a label; those of the first three kinds for every nation. ``{}`` in a reason is the label."""
    rows = []
    for kind, (status, reason) in verdicts.items():
        label = f"'{kind}/c_nationkey=' || CAST(c_nationkey AS VARCHAR)" if kind in ("good", "mismatch", "badutf8") else f"'{kind}'"
        text = "CAST(NULL AS VARCHAR)" if reason is None else f"replace('{reason}', '{{}}', {label})"
        rows.append(f"SELECT {label} AS label, '{status}' AS status, {text} AS reason" + (f" FROM ({_NATIONS})" if "||" in label else ""))
    return "\nUNION ALL ".join(rows)


_SWAPPED = _MISMATCH + "[''c_name'', ''c_custkey'', ''c_acctbal'', ''c_mktsegment'']"
SQL_FILE_GATE = _sql_gate({
    "good": ("accepted", None), "mismatch": ("schema_mismatch", _SWAPPED), "badutf8": ("unreadable", "File is not readable - {}"),
    "headeronly": ("header_only", "File contains only header without data - {}"), "blankfirst": ("empty", "File empty - {}"),
    "zerobyte": ("empty", "File empty - {}"), "missing": ("not_found", "File not found - {}")})


def q_schema_gate(spark, sf):
    return _gate(spark, sf, ("validate_schema",))


SQL_SCHEMA_GATE = _sql_gate({
    "good": ("accepted", None), "mismatch": ("schema_mismatch", _SWAPPED), "badutf8": ("schema_mismatch", _MISMATCH + "[data]"),
    "headeronly": ("accepted", None), "blankfirst": ("schema_mismatch", _MISMATCH + "[" + "'" * 4 + "]"),
    "zerobyte": ("schema_mismatch", None), "missing": ("not_found", "File not found - {}")})


def q_quarantine_lines(spark, sf):
    """Every data line of the rejected files, byte for byte, with the reason."""
    root = _landing(spark, sf)
    v = judge_files(spark, [root], GATE_CONTRACT)
    q = quarantine_lines(spark, v)
    data_line = ~F.col("line").startswith("c_") & F.col("line").rlike(r"\S")
    return q.where(data_line).select(_label("file_path").alias("label"), F.hex(F.col("line").cast("binary")).alias("line_hex"), _reason().alias("reason"))


SQL_QUARANTINE_LINES = f"""
WITH c AS (SELECT *, CAST(c_custkey AS VARCHAR) AS k, CAST(c_acctbal AS VARCHAR) AS b, 'c_nationkey=' || CAST(c_nationkey AS VARCHAR) AS n FROM customer)
SELECT 'mismatch/' || n AS label, hex(encode(concat_ws(',', c_name, k, b, c_mktsegment))) AS line_hex, '{_SWAPPED}' AS reason FROM c
UNION ALL SELECT 'badutf8/' || n, hex(encode(k || ',' || c_name)) || 'FF' || hex(encode(',' || b || ',' || c_mktsegment)), 'File is not readable - badutf8/' || n FROM c
UNION ALL SELECT 'blankfirst', hex(encode('1,x,1.0,AUTO')), 'File empty - blankfirst'
"""


# ------------------------------------------------------------ pipelines
FINAL_COLS = [c for c in L1_CUSTOMER_COLS if c != "source_file"]


def _landed(spark, sf, one_word_names: bool = False) -> tuple[str, TableContract, TableContract, TableContract]:
    base = scratch_path(spark, "lake")
    rcv, l0, l1 = _c("rcv", "customers"), _c("l0", "customers"), _c("l1", "customers")
    g = q_gen_customers(spark, sf)
    if one_word_names:
        g = g.withColumn("name", F.when(F.col("id").endswith("7"), F.split_part("name", F.lit(" "), F.lit(1))).otherwise(F.col("name")))
    write_table(g, layer_path(base, rcv, "rcv", PROCESS_DATE, "csv"), "csv")
    return base, rcv, l0, l1


def q_pipeline_rcv_l0(spark, sf):
    base, rcv, l0, _ = _landed(spark, sf)
    rcv_to_l0(spark, rcv, l0, base, PROCESS_DATE, RUN_TS, on_reject="skip")
    out = read_table(spark, layer_path(base, l0, "l0", PROCESS_DATE, "csv"), "csv", contract=l0)
    label = F.regexp_extract("source_file", r"/lake-[0-9a-f]+/(.*)/part-", 1)
    return align(out, l0).withColumn("source_file", label)


SQL_L0_TYPED = f"""
SELECT nullif(id, '') AS id, nullif(name, '') AS name,
  CASE WHEN regexp_full_match(birthday, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(birthday AS DATE) END AS birthday,
  nullif(address, '') AS address, TRY_CAST(kpi AS DOUBLE) AS kpi, TIMESTAMP '{RUN_TS_TEXT}' AS process_date
FROM ({SQL_GEN_CUSTOMERS})
"""
SQL_PIPELINE_RCV_L0 = f"SELECT *, 'rcv/retail/customers/2026/01/01/customers.csv' AS source_file FROM ({SQL_L0_TYPED})"

SQL_PIPELINE_L1 = f"""
WITH v AS (SELECT * FROM ({SQL_L0_TYPED})
           WHERE id IS NOT NULL AND name IS NOT NULL AND birthday IS NOT NULL AND address IS NOT NULL
             AND kpi IS NOT NULL AND kpi >= 0 AND kpi <= 100)
SELECT id AS customer_id, {_sql_split_name('name')}, birthday, {_sql_split_address('address')},
       kpi, process_date
FROM v
"""


def q_pipeline_l0_l1(spark, sf):
    base, rcv, l0, l1 = _landed(spark, sf)
    rcv_to_l0(spark, rcv, l0, base, PROCESS_DATE, RUN_TS, on_reject="skip")
    l0_to_l1(spark, l0, l1, base, PROCESS_DATE)
    return read_table(spark, layer_path(base, l1, "l1", PROCESS_DATE, "parquet"), "parquet").select(*FINAL_COLS)


def q_pipeline_audit(spark, sf):
    """The audit that l0 -> l1 writes: every refused row with its reasons."""
    base, rcv, l0, l1 = _landed(spark, sf)
    rcv_to_l0(spark, rcv, l0, base, PROCESS_DATE, RUN_TS, on_reject="skip")
    l0_to_l1(spark, l0, l1, base, PROCESS_DATE)
    audit = read_table(spark, layer_path(base, l0, "audit", PROCESS_DATE, l0.format("audit")), l0.format("audit"))
    return audit.select("id", "name", "birthday", "address", F.col("kpi").cast("double").alias("kpi"), "error_type", "error_rule", "error_column", "error_message")


_audit_v = _flagged([("not_null", c, _nn(c)) for c in ("id", "name", "birthday", "address", "kpi", "process_date")]
                    + [("range", "kpi", "kpi IS NOT NULL AND NOT (kpi >= 0 AND kpi <= 100)")])
SQL_PIPELINE_AUDIT = f"""
SELECT id, name, CAST(birthday AS VARCHAR) AS birthday, address, kpi, 'validation' AS error_type, {_audit_v['rule']} AS error_rule,
       {_audit_v['column']} AS error_column, {_audit_v['message']} AS error_message
FROM ({SQL_L0_TYPED}) WHERE {_audit_v['n']} > 0
"""


def q_pipeline_load(spark, sf):
    """Names of one word have no last name, which the serving table demands:
    those rows are refused with their reason, the others load."""
    base, rcv, l0, l1 = _landed(spark, sf, one_word_names=True)
    rcv_to_l0(spark, rcv, l0, base, PROCESS_DATE, RUN_TS, on_reject="skip")
    l0_to_l1(spark, l0, l1, base, PROCESS_DATE)
    target = f"{base}/serving/retail/customers"
    l1_to_target(spark, l1, base, PROCESS_DATE, target)
    refused = spark.read.parquet(layer_path(base, l1, "audit", PROCESS_DATE, "parquet") + ".load")
    return (L.read_target(spark, target, l1).select(*FINAL_COLS, F.lit(None).cast("string").alias("refused"))
            .unionByName(refused.select(*FINAL_COLS, F.col("error_message").alias("refused"))))


SQL_ONE_WORD = "CASE WHEN right(id, 1) = '7' THEN nullif(split_part(name, ' ', 1), '') ELSE name END"
SQL_PIPELINE_LOAD = SQL_PIPELINE_L1.replace(
    f"({SQL_GEN_CUSTOMERS})", f"(SELECT id, {SQL_ONE_WORD} AS name, birthday, address, kpi FROM ({SQL_GEN_CUSTOMERS}))")
SQL_PIPELINE_LOAD = f"SELECT *, CASE WHEN last_name IS NULL THEN 'not_null(last_name)' END AS refused FROM ({SQL_PIPELINE_LOAD})"


def q_pipeline_full(spark, sf):
    base, _, _, l1 = _landed(spark, sf)
    target = f"{base}/serving/retail/customers"
    run_table(spark, "customers", base, PROCESS_DATE, target, run_ts=RUN_TS, on_reject="skip")
    return L.read_target(spark, target, l1).select(*FINAL_COLS)


def q_pipeline_stream(spark, sf):
    """The l0 -> l1 work as a Structured Streaming ingest (availableNow)."""
    from ..streaming.ingest import start_ingest

    base = scratch_path(spark, "stream")
    rcv, l0, l1 = _c("rcv", "customers"), _c("l0", "customers"), _c("l1", "customers")
    write_table(q_gen_customers(spark, sf), f"{base}/landing", "csv")
    q = start_ingest(spark, rcv, l0, l1, f"{base}/landing", f"{base}/out", f"{base}/_checkpoint",
                     run_ts=RUN_TS)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_table(spark, f"{base}/out/l1", "parquet").select(*FINAL_COLS)


# ------------------------------------------------------------- registry
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": q_scan_parquet,
    "scan_versions": q_scan_versions,
    "scan_csv": q_scan_csv,
    "scan_csv_multiline": q_scan_csv_multiline,
    "source_index_csv": q_source_index_csv,
    "sink_csv_roundtrip": q_sink_csv_roundtrip,
    "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
    "jdbc_roundtrip": q_jdbc_roundtrip,
    "file_gate": q_file_gate,
    "schema_gate": q_schema_gate,
    "quarantine_lines": q_quarantine_lines,
    "rule_not_null": q_rule_not_null,
    "rule_unique": q_rule_unique,
    "rule_unique_composite": q_rule_unique_composite,
    "rule_at_most": q_rule_at_most,
    "rule_duplicate_row": q_rule_duplicate_row,
    "rule_duplicate_key": q_rule_duplicate_key,
    "rule_range": q_rule_range,
    "rule_datatype": q_rule_datatype,
    "rule_format": q_rule_format,
    "validate_all_rules": q_validate_all_rules,
    "route_valid": q_route_valid,
    "route_errors": q_route_errors,
    "audit_enrich": q_audit_enrich,
    "error_summary": q_error_summary,
    "count_audit": q_count_audit,
    "add_lineage": q_add_lineage,
    "split_name": q_split_name,
    "split_address": q_split_address,
    "rename_columns": q_rename_columns,
    "select_columns": q_select_columns,
    "transform_pipeline": q_transform_pipeline,
    "align_schema": q_align_schema,
    "cast_types": q_cast_types,
    "cast_date_format": q_cast_date_format,
    "load_append": q_load_append,
    "load_append_new_only": q_load_append_new_only,
    "load_replace": q_load_replace,
    "load_upsert": q_load_upsert,
    "load_upsert_composite": q_load_upsert_composite,
    "load_dispatch": q_load_dispatch,
    "load_unique_conflict": q_load_unique_conflict,
    "constraint_check": q_constraint_check,
    "constraint_default": q_constraint_default,
    "pipeline_rcv_l0": q_pipeline_rcv_l0,
    "pipeline_l0_l1": q_pipeline_l0_l1,
    "pipeline_audit": q_pipeline_audit,
    "pipeline_load": q_pipeline_load,
    "pipeline_full": q_pipeline_full,
    "pipeline_stream": q_pipeline_stream,
    "run_ledger_latest": q_run_ledger_latest,
    "gen_customers": q_gen_customers,
    "gen_orders": q_gen_orders,
    "gen_products": q_gen_products,
    "gen_province": q_gen_province,
}

ORACLE_SQL: dict[str, str] = {
    "scan_parquet": SQL_SCAN_PARQUET,
    "scan_versions": SQL_SCAN_VERSIONS,
    "scan_csv": SQL_SCAN_CSV,
    "scan_csv_multiline": SQL_SCAN_CSV_MULTILINE,
    "source_index_csv": SQL_SOURCE_INDEX_CSV,
    "sink_csv_roundtrip": SQL_CUSTOMER_TYPED,
    "sink_parquet_roundtrip": SQL_SCAN_PARQUET,
    "jdbc_roundtrip": SQL_SCAN_PARQUET,
    "file_gate": SQL_FILE_GATE,
    "schema_gate": SQL_SCHEMA_GATE,
    "quarantine_lines": SQL_QUARANTINE_LINES,
    "rule_not_null": SQL_RULE_NOT_NULL,
    "rule_unique": SQL_RULE_UNIQUE,
    "rule_unique_composite": SQL_RULE_UNIQUE_COMPOSITE,
    "rule_at_most": SQL_RULE_AT_MOST,
    "rule_duplicate_row": SQL_RULE_DUPLICATE_ROW,
    "rule_duplicate_key": SQL_RULE_DUPLICATE_KEY,
    "rule_range": SQL_RULE_RANGE,
    "rule_datatype": SQL_RULE_DATATYPE,
    "rule_format": SQL_RULE_FORMAT,
    "validate_all_rules": SQL_VALIDATE_ALL_RULES,
    "route_valid": SQL_ROUTE_VALID,
    "route_errors": SQL_ROUTE_ERRORS,
    "audit_enrich": SQL_AUDIT_ENRICH,
    "error_summary": SQL_ERROR_SUMMARY,
    "count_audit": SQL_COUNT_AUDIT,
    "add_lineage": SQL_ADD_LINEAGE,
    "split_name": SQL_SPLIT_NAME,
    "split_address": SQL_SPLIT_ADDRESS,
    "rename_columns": SQL_RENAME_COLUMNS,
    "select_columns": SQL_SELECT_COLUMNS,
    "transform_pipeline": SQL_TRANSFORM_PIPELINE,
    "align_schema": SQL_ALIGN_SCHEMA,
    "cast_types": SQL_CAST_TYPES,
    "cast_date_format": SQL_CAST_DATE_FORMAT,
    "load_append": SQL_LOAD_APPEND,
    "load_append_new_only": SQL_LOAD_APPEND_NEW_ONLY,
    "load_replace": SQL_LOAD_REPLACE,
    "load_upsert": SQL_LOAD_UPSERT,
    "load_upsert_composite": SQL_LOAD_UPSERT_COMPOSITE,
    "load_dispatch": SQL_LOAD_DISPATCH,
    "load_unique_conflict": SQL_LOAD_UNIQUE_CONFLICT,
    "constraint_check": SQL_CONSTRAINT_CHECK,
    "constraint_default": SQL_CONSTRAINT_DEFAULT,
    "pipeline_rcv_l0": SQL_PIPELINE_RCV_L0,
    "pipeline_l0_l1": SQL_PIPELINE_L1,
    "pipeline_audit": SQL_PIPELINE_AUDIT,
    "pipeline_load": SQL_PIPELINE_LOAD,
    "pipeline_full": SQL_PIPELINE_L1,
    "pipeline_stream": SQL_PIPELINE_L1,
    "run_ledger_latest": SQL_RUN_LEDGER_LATEST,
    "gen_customers": f"SELECT id, name, birthday, address, kpi FROM ({SQL_GEN_CUSTOMERS})",
    "gen_orders": (f"SELECT id, customer_id, product_id, quantity, price, order_date FROM ({SQL_GEN_ORDERS})"),
    "gen_products": SQL_GEN_PRODUCTS,
    "gen_province": SQL_GEN_PROVINCE,
}
