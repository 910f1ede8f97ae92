"""Dirty landing tables derived from the given tables.

Each generator maps rows of a driver table to the landing shape of one retail
table (all text, as in landing CSV) and injects dirt on a deterministic 10%
of rows chosen by integer hashing of the key, so the same rows are dirty on
every engine and every run.  Work is one narrow projection (plus a join to a
dimension table for customers), so it scales with the source table.

Hash: ``h(k) = (k % 1000003) * m % 1000`` stays inside 64-bit for any key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Word lists for generated names and streets.
GIVEN_NAMES = "An Binh Chau Dung Giang Hanh Khoa Lan Minh Nam Oanh Phuc Quan Son Thao Uyen Vinh Xuan Yen Hoa"
MIDDLE_NAMES = "Van Thi Duc Ngoc Minh"
FAMILY_NAMES = "Nguyen Tran Le Pham Hoang Vu Dang Bui Do Ho"
STREETS = "Le Loi|Tran Hung Dao|Nguyen Hue|Hai Ba Trung|Ly Thuong Kiet|Pasteur|Dien Bien Phu|Vo Van Tan"


def _h(key: str, m: int) -> str:
    return f"(({key} % 1000003) * {m} % 1000)"


def gen_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Landing customers: id, name, birthday, address, kpi (all text).

    Dirty: empty name (5%), ``dd-MM-yyyy`` birthday (5%), kpi 101-200 (10%).
    Names vary spacing; addresses carry stray and empty comma parts.
    """
    k = "c_custkey"
    h, h2 = _h(k, 7919), _h(k, 104729)
    fam = f"split_part('{FAMILY_NAMES}', ' ', cast({k} % 10 + 1 as int))"
    mid = f"split_part('{MIDDLE_NAMES}', ' ', cast({k} % 5 + 1 as int))"
    giv = f"split_part('{GIVEN_NAMES}', ' ', cast({k} % 20 + 1 as int))"
    street = f"split_part('{STREETS}', '|', cast({k} % 8 + 1 as int))"
    num = f"cast({k} % 997 + 1 as string)"
    bday = f"date_add(DATE'1960-01-01', cast(({k} % 1000003) * 37 % 15000 as int))"
    cols = {
        "id": f"'C' || lpad(cast({k} as string), 8, '0')",
        "name": f"""CASE WHEN {h} < 50 THEN ''
                    WHEN {k} % 3 = 0 THEN {fam} || ' ' || {mid} || ' ' || {giv}
                    WHEN {k} % 3 = 1 THEN {fam} || '   ' || {giv}
                    ELSE {fam} || ' ' || {mid} || '  ' || {giv} END""",
        "birthday": f"""CASE WHEN {h} >= 50 AND {h} < 100 THEN date_format({bday}, 'dd-MM-yyyy')
                        ELSE date_format({bday}, 'yyyy-MM-dd') END""",
        "address": f"""CASE WHEN {k} % 7 = 1 THEN ', ' || {num} || ' ' || {street} || ', ' || n_name || ','
                       WHEN {k} % 7 = 2 THEN {num} || ' ' || {street} || ', , ' || n_name
                       ELSE {num} || ' ' || {street} || ', ' || n_name END""",
        "kpi": f"""CASE WHEN {h2} < 100 THEN cast(101 + {h2} as string)
                   ELSE cast(({k} % 1000003) * 13 % 101 as string) END""",
    }
    joined = customer.join(nation.select("n_nationkey", "n_name"),
                           F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(*[F.expr(v).alias(n) for n, v in cols.items()], F.col(k).alias("_key"))


def gen_products(part: DataFrame) -> DataFrame:
    """Landing products: id, name, unit_price (text)."""
    k = "p_partkey"
    return part.select(
        F.expr(f"'P' || lpad(cast({k} as string), 8, '0')").alias("id"),
        F.col("p_name").alias("name"),
        F.expr("cast(cast(round(p_retailprice * 100) as bigint) as string)").alias("unit_price"),
        F.col(k).alias("_key"))


def gen_province(nation: DataFrame) -> DataFrame:
    """Landing provinces: id, name (text)."""
    return nation.select(
        F.expr("'PV' || lpad(cast(n_nationkey as string), 3, '0')").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("bigint").alias("_key"))


def gen_orders(orders: DataFrame) -> DataFrame:
    """Landing orders: id, customer_id, product_id, quantity, price, order_date.

    Dirty: empty customer_id (5%), quantity -5..0 (5%), non-numeric quantity
    (1%), unparseable order date (1%).
    """
    k = "o_orderkey"
    h, h3 = _h(k, 7919), _h(k, 15485863)
    cols = {
        "id": f"'O' || lpad(cast({k} as string), 10, '0')",
        "customer_id": f"CASE WHEN {h} < 50 THEN '' ELSE 'C' || lpad(cast(o_custkey as string), 8, '0') END",
        "product_id": f"'P' || lpad(cast(({k} % 1000003) * 31 % 1999 as string), 8, '0')",
        "quantity": f"""CASE WHEN {h} >= 50 AND {h} < 100 THEN cast(-({h} % 6) as string)
                        WHEN {h3} < 10 THEN 'n/a'
                        ELSE cast(({k} % 1000003) * 17 % 50 + 1 as string) END""",
        "price": "cast(o_totalprice as string)",
        "order_date": f"""CASE WHEN {h3} >= 10 AND {h3} < 20 THEN date_format(o_orderdate, 'dd/MM/yyyy')
                          ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END""",
    }
    return orders.select(*[F.expr(v).alias(n) for n, v in cols.items()], F.col(k).alias("_key"))
