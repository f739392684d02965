"""The typed contract of the 27 input relations.

A relation's line lists ``column kind``; ``!`` marks a column that must not be
NULL.  The kinds say which stored types a job may plan on:

* ``code``: a string compared by the reports (flags and keys); see ``normalize``
* ``text``: a string that is only shown
* ``id``: an integer or a string that is only joined on
* ``whole``, ``number``: an integer; any exact number (sums of floats differ from run to run)
* ``money``: a decimal of at most four places
* ``moment``: a date or a timestamp
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPEC = {
    "product_master": "ItemCode code!, Title text, ISBN text, Cost money, Price money, MfgSuggestedPrice money, SectionCode text, "
    "VendorID text, UserChar15 code, Reorderable code, ItemAlias code",
    "product_master_dist": "ItemCode code!, ReportItemCode code, UPC text",
    "order_detail": "PONumber code!, ItemCode code",
    "oos_item_log": "Item code, runtime moment",
    "order_header": "PONumber code!, BuyerID text",
    "receipt_header": "RECEIPT_ID id!, RECEIPT_DATE moment",
    "receipt_detail": "RECEIPT_ID id!, ITEM code, TOTAL_QTY number",
    "ar_receipt_header": "RECEIPT_ID id!, RECEIPT_DATE moment",
    "ar_receipt_detail": "RECEIPT_ID id!, ITEM code, TOTAL_QTY number",
    "pop_receipt_header": "POPRCTNM code!, receiptdate moment, POPTYPE whole",
    "pop_receipt_line": "POPRCTNM code!, ITEMNMBR code, EXTDCOST number, UNITCOST number",
    "transfer_header": "TransferID id!",
    "transfer_detail": "TransferID id!, ItemCode code, Qty number",
    "sales_item_history": "LocationID code, ItemCode code, isreturn code, quantity number, ExtendedAmt money, unitprice money, "
    "registerprice money, XactionType code",
    "locations": "LocationID code!, LocationNo code, Name text, RetailStore code, Status code, LocationType code, DistrictCode code, "
    "RDCLocationNo code, StateCode code",
    "sop_open_header": "SOPNUMBE code!, SOPTYPE whole, CUSTNMBR code, DOCID code, BCHSOURC code",
    "sop_open_line": "SOPNUMBE code!, ITEMNMBR code, QTYTOINV number, XTNDPRCE number",
    "sop_hist_header": "SOPNUMBE code!, SOPTYPE whole, CUSTNMBR code, DOCID code, BCHSOURC code",
    "sop_hist_line": "SOPNUMBE code!, ITEMNMBR code, QTYTOINV number, XTNDPRCE number",
    "wms_available_qty": "ITEM code, AvailableQty number",
    "report_locations": "LocationNo code, Name text, Region code, Retail code",
    "shipment_header": "ShipmentNo code!, ShipmentType code, ToLocationNo code, DateTransferred moment",
    "shipment_detail": "ShipmentNo code!, ShipmentType code, Company code, VendorID code",
    "shipment_vendor_detail": "ShipmentNo code!, ShipmentType code, VendorId code",
    "sr_header": "ShipmentNo code!, ShipmentType code, BatchID id",
    "sr_detail": "BatchID id, qty number",
    "vendor_master": "VendorID code!, Name text",
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool


def _fields(spec: str) -> tuple[Field, ...]:
    pairs = (part.split() for part in spec.split(","))
    return tuple(Field(name, kind.rstrip("!"), kind.endswith("!")) for name, kind in pairs)


CONTRACT: dict[str, tuple[Field, ...]] = {name: _fields(spec) for name, spec in _SPEC.items()}


class ContractError(ValueError):
    """The tables do not fit the contract; ``problems`` names each table and column."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def _string(t: T.DataType) -> bool:
    return isinstance(t, (T.StringType, T.CharType, T.VarcharType))


def _fits(kind: str, t: T.DataType) -> bool:
    whole = isinstance(t, T.IntegralType) or (isinstance(t, T.DecimalType) and t.scale == 0)
    if kind in ("code", "text"):
        return _string(t)
    if kind == "id":
        return whole or _string(t)
    if kind == "whole":
        return whole
    if kind == "number":
        return whole or isinstance(t, T.DecimalType)
    if kind == "money":
        return whole or (isinstance(t, T.DecimalType) and t.scale <= 4)
    return isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))


def schema_problems(name: str, schema: T.StructType) -> list[str]:
    """What in ``schema`` breaks the contract of relation ``name``.  Column names
    count without case, as the reports spell one column in several ways."""
    have = {f.name.lower(): f.dataType for f in schema.fields}
    found = []
    for field in CONTRACT[name]:
        kind = have.get(field.name.lower())
        if kind is None:
            found.append(f"{name}.{field.name} is missing (expected {field.kind})")
        elif not _fits(field.kind, kind):
            found.append(f"{name}.{field.name} is {kind.simpleString()}, expected {field.kind}")
    return found


def check_schemas(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    """Raise ``ContractError`` for all misfits of the tables at once; no job runs."""
    problems = [p for name in names for p in schema_problems(name, tables[name].schema)]
    if problems:
        raise ContractError(problems)


def check_required(tables: Mapping[str, DataFrame], names: Iterable[str]) -> None:
    """Raise ``ContractError`` where a column that must not be NULL has NULLs: one pruned scan and one
    small aggregate for each table.  A column whose schema already rules NULL out is not read."""
    problems = []
    for name in names:
        nullable = {f.name.lower(): f.nullable for f in tables[name].schema.fields}
        columns = [f.name for f in CONTRACT[name] if f.required and nullable[f.name.lower()]]
        if columns:
            (row,) = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).collect()
            problems += [f"{name}.{c} is NULL in {row[c]} rows" for c in columns if row[c]]
    if problems:
        raise ContractError(problems)
