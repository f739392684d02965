"""Stand-in views: the driver's TPC-H-style tables shaped into the 27 input
relations of the two jobs (mapping in FIXTURES.md C).

Each view is one SQL SELECT in the subset that Spark SQL and DuckDB both
accept, so the Spark jobs and the DuckDB oracle read identical inputs and a
check compares operators, not adapters.  The rules shape values -- NULLs,
blanks, flags, and codes or keys that match nothing -- and never rows: every
view has one row for each row of its driver table (the header pairs split by
date add up to it, ``locations`` holds both its tables), and it is the
operators' own joins and filters that drop rows.  Real deployments read catalog tables instead
(``tillroll.sources.load_tables``).

Placeholders ``{lineitem}`` etc. name driver tables: Spark binds them to
DataFrames (``spark.sql(text, lineitem=df)``), DuckDB to its views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.contract import CONTRACT

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_PAD20 = "lpad(CAST({c} AS STRING), 20, '0')"
_SHORT7 = "right(lpad(CAST({c} AS STRING), 20, '0'), 7)"
_SHIP_TYPE = (
    "CASE {c} % 5 WHEN 0 THEN 'W' WHEN 1 THEN 'W' WHEN 2 THEN 'R' WHEN 3 THEN 'R' ELSE 'X' END"
)


def _pad20(c: str) -> str:
    return _PAD20.format(c=c)


def _short7(c: str) -> str:
    return _SHORT7.format(c=c)


def _unless(rule: str, code: str, c: str) -> str:
    """``code``, or a code outside every master where ``rule`` holds: a feed
    then has no match for that item, though all of its rows are there."""
    return f"CASE WHEN {rule} THEN 'X' || CAST({c} AS STRING) ELSE {code} END"


def _ship_type(c: str) -> str:
    return _SHIP_TYPE.format(c=c)


_SOP_HEADER = f"""
SELECT 'S' || CAST(o_orderkey AS STRING) AS SOPNUMBE,
       CASE WHEN o_orderstatus = 'O' THEN 3 ELSE 2 END AS SOPTYPE,
       CASE o_custkey % 10 WHEN 0 THEN 'SAMPLE' WHEN 1 THEN 'REPS'
            WHEN 2 THEN 'RDC' || CAST(o_custkey AS STRING)
            WHEN 3 THEN 'MRDC' || CAST(o_custkey AS STRING)
            WHEN 4 THEN 'TTB' || CAST(o_custkey AS STRING)
            WHEN 5 THEN NULL
            ELSE 'C' || CAST(o_custkey AS STRING) END AS CUSTNMBR,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'RTN' ELSE 'STD' END AS DOCID,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Sales Void'
            WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Sales Entry' END AS BCHSOURC
FROM {{orders}}
WHERE CAST(o_orderdate AS DATE) {{cmp}} DATE '1999-01-01'
"""

_SOP_LINE = f"""
SELECT 'S' || CAST(l_orderkey AS STRING) AS SOPNUMBE,
       {_unless('l_partkey % 13 = 0', _short7('l_partkey'), 'l_partkey')} AS ITEMNMBR,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(19,5)) AS QTYTOINV,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(19,5)) AS XTNDPRCE
FROM {{lineitem}}
"""

_RECEIPT_DETAIL = f"""
SELECT l_orderkey AS RECEIPT_ID,
       {_unless('l_partkey % 5 = 0', _short7('l_partkey'), 'l_partkey')} AS ITEM,
       CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(19,5)) END AS TOTAL_QTY
FROM {{lineitem}}
"""

STANDIN_SQL: dict[str, str] = {
    # Products.  'TTB' line = ECONOMY and PROMO types; Price 0 and
    # Cost NULL on a few keys; alias codes point at another product.
    "product_master": f"""
SELECT {_pad20('p_partkey')} AS ItemCode,
       p_name AS Title,
       CASE p_partkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN NULL
            ELSE '978' || CAST(p_partkey AS STRING) END AS ISBN,
       CASE WHEN p_partkey % 97 = 3 THEN NULL
            ELSE CAST(CAST(p_retailprice AS DECIMAL(19,4)) * 0.6 AS DECIMAL(19,4)) END AS Cost,
       CASE WHEN p_partkey % 50 = 7 THEN CAST(0 AS DECIMAL(19,4))
            ELSE CAST(p_retailprice AS DECIMAL(19,4)) END AS Price,
       CAST(CAST(p_retailprice AS DECIMAL(19,4)) * 1.25 AS DECIMAL(19,4)) AS MfgSuggestedPrice,
       p_type AS SectionCode,
       p_brand AS VendorID,
       CASE WHEN p_type LIKE 'ECONOMY%' OR p_type LIKE 'PROMO%' THEN 'TTB' ELSE 'GEN' END AS UserChar15,
       CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS Reorderable,
       CASE WHEN p_partkey % 17 = 0 THEN 'UPC' || CAST(p_partkey + 5 AS STRING) END AS ItemAlias
FROM {{part}}
""",
    # Report code shared by groups of four keys; NULL on every tenth key.
    "product_master_dist": f"""
SELECT {_pad20('p_partkey')} AS ItemCode,
       CASE WHEN p_partkey % 10 = 0 THEN NULL
            ELSE {_pad20('p_partkey - p_partkey % 4')} END AS ReportItemCode,
       'U' || CAST(p_partkey AS STRING) AS UPC
FROM {{part}}
""",
    # Purchase-order lines.
    "order_detail": f"""
SELECT lpad(CAST(l_orderkey AS STRING), 10, '0') AS PONumber,
       {_pad20('l_partkey')} AS ItemCode
FROM {{lineitem}}
""",
    # T4: out-of-stock log, one entry per event (item = user id, unpadded);
    # only error events are recent, the others lie three years back.
    "oos_item_log": """
SELECT CAST(user_id AS STRING) AS Item,
       CASE WHEN event_type = 'error' THEN ts ELSE ts - INTERVAL '3' YEAR END AS runtime
FROM {events}
""",
    # T5: purchase-order headers; some buyers NULL.
    "order_header": """
SELECT lpad(CAST(o_orderkey AS STRING), 10, '0') AS PONumber,
       CASE WHEN o_custkey % 20 = 19 THEN NULL
            ELSE 'B' || CAST(o_custkey % 20 AS STRING) END AS BuyerID
FROM {orders}
""",
    # Receipt headers, current from 1998 on, archive before.
    "receipt_header": """
SELECT o_orderkey AS RECEIPT_ID, o_orderdate AS RECEIPT_DATE
FROM {orders}
WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01'
""",
    "ar_receipt_header": """
SELECT o_orderkey AS RECEIPT_ID, o_orderdate AS RECEIPT_DATE
FROM {orders}
WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'
""",
    # Receipt lines; the header join splits the two.
    "receipt_detail": _RECEIPT_DETAIL,
    "ar_receipt_detail": _RECEIPT_DETAIL,
    # Legacy purchasing receipts, dated ten years on so that the
    # 2010-06-30 cutoff splits them; unit cost 0 on line 7, NULL on line 6.
    "pop_receipt_header": """
SELECT 'P' || CAST(o_orderkey AS STRING) AS POPRCTNM,
       o_orderdate + INTERVAL '10' YEAR AS receiptdate,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS POPTYPE
FROM {orders}
""",
    "pop_receipt_line": f"""
SELECT 'P' || CAST(l_orderkey AS STRING) AS POPRCTNM,
       {_unless('l_partkey % 5 = 0', _short7('l_partkey'), 'l_partkey')} AS ITEMNMBR,
       CAST(CAST(l_extendedprice AS DECIMAL(19,2)) * CAST(l_quantity AS DECIMAL(19,5)) AS DECIMAL(19,5)) AS EXTDCOST,
       CASE l_linenumber WHEN 7 THEN CAST(0 AS DECIMAL(19,5)) WHEN 6 THEN NULL
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(19,2)) AS DECIMAL(19,5)) END AS UNITCOST
FROM {{lineitem}}
""",
    # Transfers to stores; headers of pending orders match no line,
    # and lines flagged 'A' have no quantity, those flagged 'R' none shipped.
    "transfer_header": """
SELECT CASE WHEN o_orderstatus = 'P' THEN -o_orderkey ELSE o_orderkey END AS TransferID
FROM {orders}
""",
    "transfer_detail": f"""
SELECT l_orderkey AS TransferID,
       {_unless('l_partkey % 7 = 0', _pad20('l_partkey'), 'l_partkey')} AS ItemCode,
       CAST(CASE l_returnflag WHEN 'N' THEN l_quantity WHEN 'R' THEN 0 END AS DECIMAL(19,5)) AS Qty
FROM {{lineitem}}
""",
    # Register sales at supplier-locations; 'R' lines are returns,
    # 'N' lines have no return flag; a markdown when discount > tax.
    "sales_item_history": f"""
SELECT CAST(l_suppkey AS STRING) AS LocationID,
       {_unless('l_partkey % 9 = 0', _pad20('l_partkey'), 'l_partkey')} AS ItemCode,
       CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS isreturn,
       CAST(l_quantity AS DECIMAL(19,5)) AS quantity,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS ExtendedAmt,
       CAST(l_extendedprice AS DECIMAL(19,4)) AS unitprice,
       CAST(CAST(l_extendedprice AS DECIMAL(19,4))
            * (1 + CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(19,4)) AS registerprice,
       CASE l_linestatus WHEN 'F' THEN 'S' ELSE 'V' END AS XactionType
FROM {{lineitem}}
""",
    # Stores (one per nation, numbers 00000-00024) plus register
    # locations (one per supplier, numbers from 00025 or 'HQ...').
    "locations": """
SELECT 'N' || CAST(n_nationkey AS STRING) AS LocationID,
       lpad(CAST(n_nationkey AS STRING), 5, '0') AS LocationNo,
       n_name AS Name,
       CASE WHEN n_nationkey % 6 = 5 THEN 'N' ELSE 'Y' END AS RetailStore,
       'A' AS Status,
       CASE WHEN n_nationkey % 8 = 7 THEN 'W' ELSE 'S' END AS LocationType,
       'D' || CAST(n_regionkey AS STRING) AS DistrictCode,
       lpad(CAST(n_regionkey AS STRING), 5, '0') AS RDCLocationNo,
       'ST' || CAST(n_nationkey % 4 AS STRING) AS StateCode
FROM {nation}
UNION ALL
SELECT CAST(s_suppkey AS STRING) AS LocationID,
       CASE WHEN s_suppkey % 10 = 0 THEN 'HQ' || CAST(s_suppkey AS STRING)
            ELSE lpad(CAST(25 + (s_suppkey * 7) % 251 AS STRING), 5, '0') END AS LocationNo,
       s_name AS Name,
       CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS RetailStore,
       CASE WHEN s_nationkey < 20 THEN 'A' ELSE 'I' END AS Status,
       'R' AS LocationType,
       CAST(NULL AS STRING) AS DistrictCode,
       CAST(NULL AS STRING) AS RDCLocationNo,
       CAST(NULL AS STRING) AS StateCode
FROM {supplier}
""",
    # Wholesale orders (open from 1999 on, history before); the
    # line tables hold every line and the header join splits them.
    "sop_open_header": _SOP_HEADER.replace("{cmp}", ">="),
    "sop_hist_header": _SOP_HEADER.replace("{cmp}", "<"),
    "sop_open_line": _SOP_LINE,
    "sop_hist_line": _SOP_LINE,
    # Warehouse stock; some rows are of items outside the master.
    "wms_available_qty": f"""
SELECT {_unless('p_partkey % 11 = 0', _short7('p_partkey'), 'p_partkey')} AS ITEM, p_size AS AvailableQty
FROM {{part}}
""",
    # Report locations (stores with their region).
    "report_locations": """
SELECT lpad(CAST(n_nationkey AS STRING), 5, '0') AS LocationNo,
       n_name AS Name,
       r_name AS Region,
       CASE WHEN n_nationkey % 6 = 5 THEN 'N' ELSE 'Y' END AS Retail
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
""",
    # Shipments to stores and their receipts.
    "shipment_header": f"""
SELECT CAST(o_orderkey AS STRING) AS ShipmentNo,
       {_ship_type('o_orderkey')} AS ShipmentType,
       lpad(CAST(o_custkey % 25 AS STRING), 5, '0') AS ToLocationNo,
       o_orderdate AS DateTransferred
FROM {{orders}}
""",
    "shipment_detail": f"""
SELECT CAST(l_orderkey AS STRING) AS ShipmentNo,
       {_ship_type('l_orderkey')} AS ShipmentType,
       CASE WHEN l_suppkey % 10 = 0 THEN 'SUP' WHEN l_suppkey % 10 = 1 THEN NULL
            ELSE 'OWN' END AS Company,
       CAST(l_suppkey AS STRING) AS VendorID
FROM {{lineitem}}
""",
    "shipment_vendor_detail": f"""
SELECT CAST(l_orderkey AS STRING) AS ShipmentNo,
       CASE WHEN l_returnflag = 'N' THEN 'X' ELSE {_ship_type('l_orderkey')} END AS ShipmentType,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_suppkey AS STRING) END AS VendorId
FROM {{lineitem}}
""",
    "sr_header": f"""
SELECT CAST(o_orderkey AS STRING) AS ShipmentNo,
       {_ship_type('o_orderkey')} AS ShipmentType,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS BatchID
FROM {{orders}}
""",
    "sr_detail": """
SELECT l_orderkey AS BatchID,
       CAST(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'R' THEN -l_quantity END
            AS DECIMAL(19,5)) AS qty
FROM {lineitem}
""",
    "vendor_master": """
SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'OLD' || CAST(s_suppkey AS STRING)
            ELSE CAST(s_suppkey AS STRING) END AS VendorID,
       CASE WHEN s_suppkey % 7 = 1 THEN NULL ELSE s_name END AS Name
FROM {supplier}
""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def standin_sources(name: str) -> list[str]:
    """Driver tables a stand-in view reads."""
    return sorted(set(_PLACEHOLDER.findall(STANDIN_SQL[name])))


def duckdb_standin_sql(name: str) -> str:
    """The view text with placeholders bound to DuckDB's pre-registered views."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), STANDIN_SQL[name])


def rough_sql(name: str) -> str:
    """The view with its code columns as careless writers leave them: lower-cased or blank-padded, by the
    code's last character and differently in every table, so no two tables spell a key alike."""
    k, out = list(STANDIN_SQL).index(name), []
    for field in CONTRACT[name]:
        c = field.name
        if field.kind == "code":
            c = f"CASE (ascii(right({c}, 1)) + {k}) % 3 WHEN 0 THEN lower({c}) WHEN 1 THEN {c} || '   ' ELSE {c} END AS {c}"
        out.append(c)
    return f"SELECT {', '.join(out)} FROM ({STANDIN_SQL[name]})"


class StandinTables(dict):
    """Lazy ``Tables`` mapping over one driver-data folder.

    A view is built on first access; building is lazy in Spark too (no job
    runs until an action).  The driver files are read-only, so one mapping
    per (session, folder) is kept, like a catalog caching table metadata.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, rough: bool = False):
        super().__init__()
        self._sql = rough_sql if rough else STANDIN_SQL.__getitem__
        self._spark = spark
        self._dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def _driver(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._raw[name]

    def __missing__(self, name: str) -> DataFrame:
        if name not in STANDIN_SQL:
            raise KeyError(name)
        args = {t: self._driver(t) for t in standin_sources(name)}
        df = self._spark.sql(self._sql(name), **args)
        self[name] = df
        return df


_CACHE: dict[tuple, StandinTables] = {}


def standin_tables(spark: SparkSession, sf_dir: str, rough: bool = False) -> StandinTables:
    """The views over a folder; ``rough`` ones hold the same codes in mixed case and with trailing blanks."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), rough)
    if key not in _CACHE:
        _CACHE[key] = StandinTables(spark, sf_dir, rough)
    return _CACHE[key]
