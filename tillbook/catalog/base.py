"""Registry of queries with their oracle SQL, plus the shared SQL views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.sources.fixtures import LINE_ORDER, Fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

STORES = """stores AS (
  SELECT n.n_nationkey AS store_key, n.n_name AS store, r.r_name AS region,
         'MGR_' || CAST(n.n_nationkey % 7 AS VARCHAR) AS manager,
         CAST(DATE '1995-01-01' + CAST(n.n_nationkey * 30 AS INTEGER) AS DATE) AS open_date
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""
HEADS = STORES + """, heads AS (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS sale_date, strftime(o.o_orderdate, '%Y-%m') AS ym,
         o.o_orderstatus AS source, s.store, s.region, s.manager, s.open_date, c.c_mktsegment AS platform,
         o.o_orderpriority AS order_type, CAST(o.o_orderkey AS VARCHAR) AS order_id,
         lpad(CAST(o.o_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
           lpad(CAST(o.o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' AS order_time,
         CAST(round(o.o_totalprice) AS BIGINT) AS order_amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN stores s ON c.c_nationkey = s.store_key)"""
RAW_LINES = """raw_lines AS (
  SELECT l.*, CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice) AS BIGINT) AS list_amount,
         CAST(round(l_extendedprice * (1 - l_discount)) AS BIGINT) AS net_amount,
         CAST(round(l_extendedprice * l_discount) AS BIGINT) AS discount_amount,
         CAST(round(l_extendedprice * (1 - l_discount) * (1 - l_tax)) AS BIGINT) AS settle_amount,
         CAST(round(l_extendedprice / l_quantity) AS BIGINT) AS unit_price
  FROM lineitem l)"""
LINES = HEADS + ", " + RAW_LINES + """, lines AS (
  SELECT l.*, h.*, l.l_linestatus AS brand, CAST(l.l_partkey AS VARCHAR) AS item_id,
         CASE WHEN l.l_returnflag = 'R' THEN '취소' ELSE '정상' END AS sale_type,
         CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END * l.net_amount AS total_price,
         CASE WHEN l.l_linenumber <> 1 THEN 0 WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END AS order_cnt
  FROM raw_lines l JOIN heads h ON l.l_orderkey = h.o_orderkey)"""
SERIES = LINES + """, series AS (
  SELECT sale_date, store, manager, CAST(sum(total_price) AS BIGINT) AS total_amount,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN -settle_amount ELSE settle_amount END) AS BIGINT) AS settlement_amount,
         count(DISTINCT order_id) AS total_order_count
  FROM lines GROUP BY sale_date, store, manager)"""
EVENTS = """ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS d, user_id, 'S' || lpad(CAST(user_id % 25 AS VARCHAR), 2, '0') AS store,
         event_type, CAST(round(value * 100) AS BIGINT) AS amount,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, props
  FROM events)"""
REVIEWS = """rev AS (
  SELECT d.doc_id, CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS DATE) AS d,
         'S' || lpad(CAST(d.doc_id % 25 AS VARCHAR), 2, '0') AS store,
         'MGR_' || CAST((d.doc_id % 25) % 7 AS VARCHAR) AS manager,
         d.source AS channel, d.lang AS topic,
         CASE WHEN l.toxic = 1 THEN 'negative' ELSE 'positive' END AS sentiment,
         l.quality, l.toxic, d.text, d.n_chars
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
PRODUCTS = """products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS code, p_partkey AS part_key, p_name AS name, p_brand AS brand, p_type AS label,
         p_size AS size, CAST(round(p_retailprice) AS BIGINT) AS list_price FROM part)"""
LINE_SEQ = ", ".join(LINE_ORDER)


TABLES = """region(r_regionkey INTEGER, r_name VARCHAR);
nation(n_nationkey INTEGER, n_name VARCHAR, n_regionkey INTEGER);
customer(c_custkey BIGINT, c_name VARCHAR, c_nationkey INTEGER, c_acctbal DOUBLE, c_mktsegment VARCHAR);
supplier(s_suppkey BIGINT, s_name VARCHAR, s_nationkey INTEGER, s_acctbal DOUBLE);
part(p_partkey BIGINT, p_name VARCHAR, p_brand VARCHAR, p_type VARCHAR, p_size INTEGER, p_retailprice DOUBLE);
orders(o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority VARCHAR);
lineitem(l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE, l_extendedprice DOUBLE,
  l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR, l_shipdate TIMESTAMP);
events(event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR);
documents(doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT);
labels(doc_id BIGINT, quality INTEGER, toxic INTEGER)"""


def oracle_with_wide_integers() -> dict[str, str]:
    """The oracle SQL with every whole-number column as BIGINT, the type the Spark side returns.

    Column types come from binding each query to empty tables.
    """
    try:
        import duckdb
    except ImportError:
        return dict(ORACLE)
    con = duckdb.connect()
    for table in TABLES.split(";"):
        con.execute(f"CREATE TABLE {table.strip()}")
    out = {}
    for name, sql in ORACLE.items():
        narrow = [c[0] for c in con.execute(f"DESCRIBE {sql}").fetchall() if c[1] == "INTEGER"]
        casts = ", ".join(f'CAST("{c}" AS BIGINT) AS "{c}"' for c in narrow)
        out[name] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if narrow else sql
    return out


def rnd(expr: str, digits: int = 2) -> str:
    """Half-even rounding on the decimal value, as text for the oracle."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(30, 8)), {digits}) AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def rint(expr: str) -> str:
    return f"COALESCE(CAST(round_even(CAST({expr} AS DOUBLE), 0) AS BIGINT), 0)"


def tint(expr: str) -> str:
    return f"COALESCE(CAST(trunc({expr}) AS BIGINT), 0)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


def pct(now: str, base: str, digits: int = 2) -> str:
    return rnd(f"{ratio(f'(({now}) - ({base}))', base)} * 100", digits)


def _plain(df: DataFrame) -> DataFrame:
    """Comparison form: dates and times as text, decimals as double, lists joined."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(Fixture) -> DataFrame`` under ``name`` with its oracle."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: _plain(fn(Fixture(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = " ".join(sql.split("\n")) if "--" not in sql else sql
        return fn

    return deco
