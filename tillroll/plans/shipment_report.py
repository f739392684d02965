"""Entry point: shipments not received, for a date range, store filter and
vendor choice ('All', 'CDC' or one vendor code)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.fixed import ALL_VENDORS, VENDOR_PARAM_WIDTH, WAREHOUSE_VENDOR
from tillroll.operators import shipments as S
from tillroll.operators.params import varchar_param
from tillroll.plans.stages import checkpointed
from tillroll.sources.normalize import canonical_tables
from tillroll.sources.tables import Tables


def report_mode(vendor_id: str) -> str:
    v = (varchar_param(vendor_id, VENDOR_PARAM_WIDTH) or "").rstrip().upper()
    if v == ALL_VENDORS.upper():
        return "all"
    if v == WAREHOUSE_VENDOR.upper():
        return "cdc"
    return "vendor"


def shipment_not_received(
    tables: Tables,
    start,
    end,
    filter_type: str = "All Locations",
    dyn_filter: str | None = None,
    vendor_id: str = "All",
    reuse: bool = True,
    stage=None,
) -> DataFrame:
    """Shipments sent to the chosen stores in [start, end] never received.

    With ``reuse`` each set (by ``stage``, default ``checkpointed``) that several steps read is written once: the
    headers in range, the shipments, their receipt headers, and the
    difference, which feeds the vendor labels and the result.
    """
    tables = canonical_tables(tables)
    mode = report_mode(vendor_id)
    vendor = (varchar_param(vendor_id, VENDOR_PARAM_WIDTH) or "").rstrip() if mode == "vendor" else None
    stores = S.resolve_locations(tables["locations"], tables["report_locations"], filter_type, dyn_filter)
    stage = stage or checkpointed if reuse else None
    ships = S.shipments_in_range(
        tables["shipment_header"], tables["shipment_detail"], stores, start, end, mode, vendor, stage
    )
    n = n_open = None
    if reuse:
        ships, n = stage(ships, "shipments")
    open_ships = S.not_received(ships, S.received_shipments(ships, tables["sr_header"], tables["sr_detail"], stage, n))
    if mode == "cdc":
        return S.not_received_cdc(open_ships)
    if reuse:
        open_ships, n_open = stage(open_ships, "not-received")
    svd, vm = tables["shipment_vendor_detail"], tables["vendor_master"]
    return (S.not_received_all if mode == "all" else S.not_received_vendor)(open_ships, svd, vm, n_open)
