"""Shipments sent to stores that were never received.

Flow: pick stores (M17) -> shipments to them in a date range (M18) ->
shipments with a positive received quantity (M19) -> the difference, one anti
join -> labels (M20 all vendors, M21 warehouse only, M22 one vendor).

The plan is the same at every size.  Tables without a date or a store (lines,
receipt headers, receipt lines) are cut in their scans by bitmaps of the
shipments at hand; no side is counted to choose a strategy, and dimensions are
joined without hints, by Spark's own size estimates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import mmddyyyy, store_label, vendor_label
from tillroll.operators.bitmap_cut import cut_by_bitmap
from tillroll.operators.params import as_datetime, char_param, ts_literal
from tillroll.sources.normalize import canonical, fold_text
from tillroll.fixed import (
    DROP_SHIP_TYPE,
    MODE_TYPES,
    PARAM_CHAR_WIDTH,
    RDC_EXCLUDED,
    RETAIL_FLAG,
    STORE_TYPE,
    SUPPLY_COMPANY,
    WAREHOUSE_TYPE,
    WAREHOUSE_VENDOR as WAREHOUSE_LABEL,
)


SHIP_KEYS = ["ShipmentNo", "ShipmentType"]


def resolve_locations(
    locations: DataFrame,
    report_locations: DataFrame,
    filter_type: str,
    dyn_filter: str | None = None,
) -> DataFrame:
    """The store set for a filter type -> (LocationNo, LocationName).

    The type and the value are compared as the collation does: case and
    trailing blanks do not count.
    'All Locations' and 'State' require LocationType 'S'; 'Store',
    'District', 'Region' and 'RDC' do not.  An unknown type gives no stores.
    """
    locations, report_locations = canonical(locations, "locations"), canonical(report_locations, "report_locations")
    ft = fold_text(char_param(filter_type, PARAM_CHAR_WIDTH) or "")
    dyn = char_param(dyn_filter, PARAM_CHAR_WIDTH)
    dyn = None if dyn is None else fold_text(dyn)
    retail = F.col("RetailStore") == RETAIL_FLAG
    if ft == "ALL LOCATIONS":
        src = locations.filter((F.col("LocationType") == STORE_TYPE) & retail)
    elif ft == "STORE":
        src = locations.filter((F.col("LocationNo") == F.lit(dyn)) & retail)
    elif ft == "DISTRICT":
        src = locations.filter((F.col("DistrictCode") == F.lit(dyn)) & retail)
    elif ft == "REGION":
        src = report_locations.filter((F.col("Region") == F.lit(dyn)) & (F.col("Retail") == RETAIL_FLAG))
    elif ft == "RDC":
        src = locations.filter(
            ~F.col("LocationNo").isin(*RDC_EXCLUDED) & (F.col("RDCLocationNo") == F.lit(dyn)) & retail
        )
    elif ft == "STATE":
        src = locations.filter(
            (F.col("LocationType") == STORE_TYPE) & retail & (F.col("StateCode") == F.lit(dyn))
        )
    else:
        src = locations.filter(F.lit(False))
    return src.select("LocationNo", F.col("Name").alias("LocationName"))


def shipments_in_range(
    shipment_header: DataFrame,
    shipment_detail: DataFrame,
    stores: DataFrame,
    start,
    end,
    mode: str = "all",
    vendor_id: str | None = None,
    stage=None,
) -> DataFrame:
    """Distinct shipments to the stores, transferred from ``start`` to
    the end of day ``end`` (the end day is included).

    'all'/'cdc' keep a shipment when any of its lines is not a supply line;
    'vendor' keeps R shipments with a line from ``vendor_id`` and adds the
    VendorID column.  ``stage`` writes the headers in range once: the cut of
    the lines and the join read them.
    """
    types = MODE_TYPES[mode]
    shipment_header, shipment_detail = canonical(shipment_header, "shipment_header"), canonical(shipment_detail, "shipment_detail")
    end_excl = as_datetime(end) + dt.timedelta(days=1)
    sh = shipment_header.filter(
        (F.col("DateTransferred") >= ts_literal(start))
        & (F.col("DateTransferred") < ts_literal(end_excl))
        & F.col("ShipmentType").isin(*types)
    ).select("ShipmentNo", "ShipmentType", "ToLocationNo", "DateTransferred")

    n = None
    if stage is not None:
        sh, n = stage(sh, "headers-in-range")
    lines = shipment_detail.filter(F.col("ShipmentType").isin(*types))
    if mode == "vendor":
        lines = lines.filter(F.col("VendorID") == F.lit(fold_text(vendor_id))).select(*SHIP_KEYS, "VendorID")
    else:
        lines = lines.filter(F.col("Company") != SUPPLY_COMPANY).select(*SHIP_KEYS)
    # Lines carry no date: cut in their scan to the shipments in range, then
    # deduplicated per shipment map-side, so one very large shipment
    # contributes one key per map task.
    keep = cut_by_bitmap(lines, sh, SHIP_KEYS, n).distinct()
    sh = sh.join(keep, SHIP_KEYS, "inner" if mode == "vendor" else "left_semi")

    st = stores.select(F.col("LocationNo").alias("ToLocationNo"), "LocationNo", "LocationName")
    j = sh.join(st, "ToLocationNo")
    cols = [
        "ShipmentNo",
        "ShipmentType",
        store_label(F.col("LocationNo"), F.col("LocationName")).alias("Location"),
        "ToLocationNo",
        mmddyyyy(F.col("DateTransferred")).alias("ShipmentDate"),
    ]
    if mode == "vendor":
        cols.append("VendorID")
    return j.select(*cols).distinct()


def received_shipments(
    shipments: DataFrame,
    sr_header: DataFrame,
    sr_detail: DataFrame,
    stage=None,
    shipments_rows: int | None = None,
) -> DataFrame:
    """(ShipmentNo, ShipmentType, qty) with ``sum(qty) > 0``.

    Same sum as joining every shipment row to its receipt headers and lines,
    computed without the fan-out: receipt lines are summed per batch
    (partial aggregation, so a huge batch costs one row per map task), the
    batch sums are rolled up per shipment, then scaled by how many rows the
    shipment has in ``shipments``.
    """
    sr_header = canonical(sr_header, "sr_header")
    rows_per_ship = shipments.groupBy(*SHIP_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    heads = cut_by_bitmap(sr_header.select(*SHIP_KEYS, "BatchID"), shipments, SHIP_KEYS, shipments_rows)
    n = None
    if stage is not None:  # read by the cut of the receipt lines and by the join
        heads, n = stage(heads, "receipt-headers")
    lines = cut_by_bitmap(sr_detail.select("BatchID", "qty"), heads, ["BatchID"], n)
    batch_qty = lines.groupBy("BatchID").agg(F.sum("qty").alias("bq"))
    per_ship = heads.join(batch_qty, "BatchID").groupBy(*SHIP_KEYS).agg(F.sum("bq").alias("q"))
    out = per_ship.join(rows_per_ship, SHIP_KEYS).select(
        *SHIP_KEYS, (F.col("q") * F.col("n_rows")).cast("decimal(38,5)").alias("qty")
    )
    return out.filter(F.col("qty") > 0)


def not_received(shipments: DataFrame, received: DataFrame) -> DataFrame:
    """The difference: shipments without a positive received quantity.  The
    report jobs write it once; labels and result both read it."""
    return shipments.join(received.select(*SHIP_KEYS), SHIP_KEYS, "left_anti")


def _with_vendor_labels(open_ships: DataFrame, shipment_vendor_detail: DataFrame, vendor_master: DataFrame, rows: int | None) -> DataFrame:
    """Left-join each drop shipment's line vendors and their names.

    Lines are cut in their scan to the shipments at hand and deduplicated per
    (shipment, vendor) before the join; the vendor master is a dimension.
    """
    vendor_master = canonical(vendor_master, "vendor_master")
    lines = canonical(shipment_vendor_detail, "shipment_vendor_detail").filter(F.col("ShipmentType") == DROP_SHIP_TYPE).select(
        *SHIP_KEYS, F.col("VendorId").alias("LineVendor")
    )
    lines = cut_by_bitmap(lines, open_ships, SHIP_KEYS, rows).distinct()
    vm = vendor_master.select(F.col("VendorID").alias("VmVendorID"), F.col("Name").alias("VmName"))
    j = open_ships.join(lines, SHIP_KEYS, "left").join(vm, F.col("LineVendor") == F.col("VmVendorID"), "left")
    return j.withColumn("VendorLabel", vendor_label(F.col("VmVendorID"), F.col("VmName")))


def not_received_all(open_ships: DataFrame, shipment_vendor_detail: DataFrame, vendor_master: DataFrame, rows: int | None = None) -> DataFrame:
    """The not-received W and R shipments (``not_received``); W labelled 'CDC', R by vendor.
    Unordered, Vendor last.  ``rows``: their number, if known."""
    labelled = _with_vendor_labels(open_ships, shipment_vendor_detail, vendor_master, rows)
    distinct_rows = labelled.select(
        F.col("VendorLabel").alias("Vendor"),
        "Location",
        "ShipmentDate",
        F.col("ShipmentNo").alias("ShipmentNumber"),
        "ShipmentType",
    ).distinct()
    return distinct_rows.select(
        "Location",
        "ShipmentDate",
        "ShipmentNumber",
        "ShipmentType",
        F.when(F.col("ShipmentType") == WAREHOUSE_TYPE, F.lit(WAREHOUSE_LABEL))
        .when(F.col("ShipmentType") == DROP_SHIP_TYPE, F.col("Vendor"))
        .alias("Vendor"),
    )


CDC_ORDER = ["Location", "ShipmentDate", "ShipmentNumber", "ShipmentType"]
VENDOR_ORDER = [*CDC_ORDER, "Vendor"]


def not_received_cdc(open_ships: DataFrame) -> DataFrame:
    """Not-received warehouse shipments, ordered; Vendor is 'CDC'."""
    return open_ships.select(
        "Location",
        "ShipmentDate",
        F.col("ShipmentNo").alias("ShipmentNumber"),
        "ShipmentType",
        F.lit(WAREHOUSE_LABEL).alias("Vendor"),
    ).orderBy(*CDC_ORDER)


def not_received_vendor(open_ships: DataFrame, shipment_vendor_detail: DataFrame, vendor_master: DataFrame, rows: int | None = None) -> DataFrame:
    """Not-received drop shipments of one vendor, labelled with every
    vendor on the shipment; Vendor first, ordered (date as text)."""
    labelled = _with_vendor_labels(open_ships, shipment_vendor_detail, vendor_master, rows)
    return (
        labelled.select(
            F.col("VendorLabel").alias("Vendor"),
            "Location",
            "ShipmentDate",
            F.col("ShipmentNo").alias("ShipmentNumber"),
            "ShipmentType",
        )
        .distinct()
        .orderBy(*VENDOR_ORDER)
    )
