"""Tiny in-memory tables with the inferred input schemas (FIXTURES.md A)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

SCHEMAS = {
    "product_master": "ItemCode string, Title string, ISBN string, Cost decimal(19,4), Price decimal(19,4), "
    "MfgSuggestedPrice decimal(19,4), SectionCode string, VendorID string, UserChar15 string, "
    "Reorderable string, ItemAlias string",
    "product_master_dist": "ItemCode string, ReportItemCode string, UPC string",
    "order_detail": "PONumber string, ItemCode string",
    "oos_item_log": "Item string, runtime timestamp_ntz",
    "order_header": "PONumber string, BuyerID string",
    "receipt_header": "RECEIPT_ID bigint, RECEIPT_DATE timestamp_ntz",
    "receipt_detail": "RECEIPT_ID bigint, ITEM string, TOTAL_QTY decimal(19,5)",
    "ar_receipt_header": "RECEIPT_ID bigint, RECEIPT_DATE timestamp_ntz",
    "ar_receipt_detail": "RECEIPT_ID bigint, ITEM string, TOTAL_QTY decimal(19,5)",
    "pop_receipt_header": "POPRCTNM string, receiptdate timestamp_ntz, POPTYPE int",
    "pop_receipt_line": "POPRCTNM string, ITEMNMBR string, EXTDCOST decimal(19,5), UNITCOST decimal(19,5)",
    "transfer_header": "TransferID bigint",
    "transfer_detail": "TransferID bigint, ItemCode string, Qty decimal(19,5)",
    "sales_item_history": "LocationID string, ItemCode string, isreturn string, quantity decimal(19,5), "
    "ExtendedAmt decimal(19,4), unitprice decimal(19,4), registerprice decimal(19,4), XactionType string",
    "locations": "LocationID string, LocationNo string, Name string, RetailStore string, Status string, "
    "LocationType string, DistrictCode string, RDCLocationNo string, StateCode string",
    "sop_open_header": "SOPNUMBE string, SOPTYPE int, CUSTNMBR string, DOCID string, BCHSOURC string",
    "sop_open_line": "SOPNUMBE string, ITEMNMBR string, QTYTOINV decimal(19,5), XTNDPRCE decimal(19,5)",
    "sop_hist_header": "SOPNUMBE string, SOPTYPE int, CUSTNMBR string, DOCID string, BCHSOURC string",
    "sop_hist_line": "SOPNUMBE string, ITEMNMBR string, QTYTOINV decimal(19,5), XTNDPRCE decimal(19,5)",
    "wms_available_qty": "ITEM string, AvailableQty int",
    "report_locations": "LocationNo string, Name string, Region string, Retail string",
    "shipment_header": "ShipmentNo string, ShipmentType string, ToLocationNo string, DateTransferred timestamp_ntz",
    "shipment_detail": "ShipmentNo string, ShipmentType string, Company string, VendorID string",
    "shipment_vendor_detail": "ShipmentNo string, ShipmentType string, VendorId string",
    "sr_header": "ShipmentNo string, ShipmentType string, BatchID bigint",
    "sr_detail": "BatchID bigint, qty decimal(19,5)",
    "vendor_master": "VendorID string, Name string",
}


def D(x) -> Decimal | None:
    return None if x is None else Decimal(str(x))


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def pad20(code: str) -> str:
    return code.rjust(20, "0")


def make_tables(spark, **rows) -> dict:
    """Every registered table, empty unless rows are given."""
    return {name: spark.createDataFrame(rows.get(name, []), SCHEMAS[name]) for name in SCHEMAS}
