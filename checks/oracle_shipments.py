"""DuckDB oracle SQL for the shipment report, from its rules:

* a shipment counts when its header lies in the range, goes to a chosen store
  and has at least one line that qualifies for the mode;
* it is received when the quantities of its batches sum to more than zero;
* what is left is labelled: warehouse shipments by a constant, drop shipments
  by each vendor on them, or by a fixed text when no known vendor is named.
"""

from __future__ import annotations

import datetime as dt

from checks.sqlkit import with_standins
from tillroll import fixed as X


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _store_rules(filter_type: str, dyn: str | None) -> tuple[str, list[str]]:
    """(table, conditions) of a store filter; an unknown filter chooses none."""
    chosen = "NULL" if dyn is None else _quoted([dyn])
    retail = f"RetailStore = '{X.RETAIL_FLAG}'"
    store = f"LocationType = '{X.STORE_TYPE}'"
    rules = {
        "All Locations": ("locations", [retail, store]),
        "Store": ("locations", [retail, f"LocationNo = {chosen}"]),
        "District": ("locations", [retail, f"DistrictCode = {chosen}"]),
        "Region": ("report_locations", [f"Retail = '{X.RETAIL_FLAG}'", f"Region = {chosen}"]),
        "RDC": ("locations", [retail, f"RDCLocationNo = {chosen}", f"NOT (LocationNo IN ({_quoted(X.RDC_EXCLUDED)}))"]),
        "State": ("locations", [retail, store, f"StateCode = {chosen}"]),
    }
    return rules.get(filter_type, ("locations", ["FALSE"]))


def locs_sql(filter_type: str, dyn: str | None) -> str:
    table, conditions = _store_rules(filter_type, dyn)
    return f"FROM {table} SELECT LocationNo, Name AS LocationName WHERE {' AND '.join(conditions)}"


def _in_range(mode: str, start: str, end: str, vendor: str | None) -> str:
    """CTEs ``stores``, ``candidates`` (headers) and ``in_range``."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if mode == "vendor":
        line_rule, extra = f"line.VendorID = {_quoted([vendor])}", f", {_quoted([vendor])} AS VendorID"
    else:
        line_rule, extra = f"line.Company <> '{X.SUPPLY_COMPANY}'", ""
    return f"""
candidates AS (
  SELECT DISTINCT ShipmentNo, ShipmentType, ToLocationNo, CAST(DateTransferred AS DATE) AS shipped
  FROM shipment_header AS head
  WHERE CAST(DateTransferred AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'
    AND ShipmentType IN ({_quoted(X.MODE_TYPES[mode])})
    AND EXISTS (FROM shipment_detail AS line
                WHERE line.ShipmentNo = head.ShipmentNo AND line.ShipmentType = head.ShipmentType AND {line_rule})),
store_labels AS (
  SELECT DISTINCT LocationNo AS ToLocationNo,
         concat(rpad(LocationNo, {X.LOCATION_NO_WIDTH}, ' '), '{X.LABEL_SEPARATOR}',
                rpad(LocationName, {X.LOCATION_NAME_WIDTH}, ' ')) AS Location
  FROM stores WHERE LocationName IS NOT NULL
  UNION SELECT LocationNo, NULL FROM stores WHERE LocationName IS NULL),
in_range AS (
  SELECT ShipmentNo, ShipmentType, Location, ToLocationNo, strftime(shipped, '%m/%d/%Y') AS ShipmentDate{extra}
  FROM candidates JOIN store_labels USING (ToLocationNo))"""


# A shipment with several rows in range has its received quantity once for each.
_RECEIVED = """
batch_totals AS (SELECT BatchID, sum(qty) AS units FROM sr_detail GROUP BY BatchID),
shipment_totals AS (
  SELECT ShipmentNo, ShipmentType, sum(units) AS units
  FROM sr_header JOIN batch_totals USING (BatchID) GROUP BY ALL),
received AS (
  SELECT ShipmentNo, ShipmentType, CAST(sum(units) AS DECIMAL(38,5)) AS qty
  FROM in_range JOIN shipment_totals USING (ShipmentNo, ShipmentType)
  GROUP BY ALL HAVING sum(units) > 0)"""

_OPEN = """
outstanding AS (SELECT * FROM in_range ANTI JOIN received USING (ShipmentNo, ShipmentType))"""

# One name for each vendor on a drop shipment; a vendor the master does not know has none.
_NAMED = f"""
named AS (
  SELECT DISTINCT d.ShipmentNo, concat(v.VendorID, '{X.LABEL_SEPARATOR}', coalesce(v.Name, '')) AS Vendor
  FROM shipment_vendor_detail AS d JOIN vendor_master AS v ON v.VendorID = d.VendorId
  WHERE d.ShipmentType = '{X.DROP_SHIP_TYPE}'
  UNION
  SELECT ShipmentNo, '{X.NO_VENDOR_TEXT}{X.LABEL_SEPARATOR}'
  FROM shipment_vendor_detail AS d
  WHERE ShipmentType = '{X.DROP_SHIP_TYPE}' AND NOT EXISTS (FROM vendor_master AS v WHERE v.VendorID = d.VendorId)),
unnamed AS (
  SELECT DISTINCT ShipmentNo, '{X.NO_VENDOR_TEXT}{X.LABEL_SEPARATOR}' AS Vendor
  FROM outstanding ANTI JOIN named USING (ShipmentNo))"""

_COLUMNS = "Location, ShipmentDate, ShipmentNo AS ShipmentNumber, ShipmentType"


def _chain(filter_type, dyn, *ctes: str) -> str:
    return f"WITH stores AS ({locs_sql(filter_type, dyn)})," + ",".join(ctes) + "\n"


def stores_sql(filter_type: str, dyn: str | None) -> str:
    return with_standins(locs_sql(filter_type, dyn))


def shipments_sql(mode, start, end, vendor=None, filter_type="All Locations", dyn=None) -> str:
    return with_standins(_chain(filter_type, dyn, _in_range(mode, start, end, vendor)) + "SELECT * FROM in_range")


def received_sql(mode, start, end, vendor=None, filter_type="All Locations", dyn=None, standins=True) -> str:
    body = _chain(filter_type, dyn, _in_range(mode, start, end, vendor), _RECEIVED) + "SELECT * FROM received"
    return with_standins(body) if standins else body


def not_received_sql(mode, start, end, vendor=None, filter_type="All Locations", dyn=None, standins=True) -> str:
    """``standins=False`` leaves the table names to the caller's database."""
    ctes = [_in_range(mode, start, end, vendor), _RECEIVED, _OPEN]
    warehouse = f"SELECT {_COLUMNS}, '{X.WAREHOUSE_VENDOR}' AS Vendor FROM outstanding"
    drop_ship = (
        f"SELECT {_COLUMNS}, Vendor FROM outstanding JOIN (FROM named UNION ALL FROM unnamed) USING (ShipmentNo) "
        f"WHERE ShipmentType = '{X.DROP_SHIP_TYPE}'"
    )
    if mode == "cdc":
        final = warehouse
    else:
        ctes.append(_NAMED)
        final = f"SELECT DISTINCT * FROM ({drop_ship})"
        if mode == "all":
            final += f" UNION ALL SELECT DISTINCT * FROM ({warehouse} WHERE ShipmentType = '{X.WAREHOUSE_TYPE}')"
    body = _chain(filter_type, dyn, *ctes) + final
    return with_standins(body) if standins else body


def positions_sql(mode: str, start: str, end: str, vendor: str | None = None) -> str:
    """The report and each row's place in its order (dates as the text they are shown as)."""
    order = "Location, ShipmentDate, ShipmentNumber, ShipmentType" + (", Vendor" if mode == "vendor" else "")
    firsts = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split(", "))
    return f"SELECT *, row_number() OVER (ORDER BY {firsts}) AS position FROM ({not_received_sql(mode, start, end, vendor)})"
