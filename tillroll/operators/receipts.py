"""Receipts per item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money, to_int
from tillroll.operators.documents import TIMES, meet_headers, times
from tillroll.operators.params import ts_literal
from tillroll.operators.weights import CodeKeys, ItemWeights, int_times
from tillroll.fixed import POP_CUTOFF, POP_RECEIPT_TYPE


QTY = "decimal(38,5)"
RECEIPT_COLS = ["ItemCode", "RcvdDate", "RcvdQty", "RcvdAmt"]


def receipt_sums(header: DataFrame, detail: DataFrame, keys: CodeKeys, stage=None) -> DataFrame:
    """One receipt feed summed per item code (the fact-side work): lines cut
    to the codes (written once by ``stage``, if given) meet their header, then are summed per item, map-side first."""
    d = keys.cut(detail.select("RECEIPT_ID", F.col("ITEM").alias("ItemCode"), "TOTAL_QTY"), "ItemCode")
    f = meet_headers(d, header, "RECEIPT_ID", "RECEIPT_DATE", stage)
    q = F.col("TOTAL_QTY") * F.col(TIMES)
    sums = f.groupBy("ItemCode").agg(
        F.min("_date").alias("RcvdDate"),
        F.sum(F.coalesce(q, F.lit(0))).cast(QTY).alias("_q0"),
        F.sum(q).cast(QTY).alias("_q1"),
    )
    return keys.exact(sums, "ItemCode")


def _scale_receipts(sums: DataFrame, w: ItemWeights) -> DataFrame:
    j = sums.join(w.per_code(), "ItemCode")
    return j.select(
        "ItemCode",
        "RcvdDate",
        to_int(F.col("_q0") * F.col("n")).alias("RcvdQty"),
        money(F.col("_q1") * F.col("n") * F.col("max_cost")).alias("RcvdAmt"),
    )


def receipts_by_item(
    receipt_header: DataFrame,
    receipt_detail: DataFrame,
    ar_receipt_header: DataFrame,
    ar_receipt_detail: DataFrame,
    w: ItemWeights,
    sums: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """M8: per item, first receipt date, quantity and cost-valued amount from
    the current and the archive receipts; the two feeds are set-unioned
    (identical rows from both count once).  ``sums`` are the two feeds'
    ``receipt_sums`` when already computed (for a superset of the codes)."""
    cur, arc = sums or (
        receipt_sums(receipt_header, receipt_detail, w.keys),
        receipt_sums(ar_receipt_header, ar_receipt_detail, w.keys),
    )
    return _scale_receipts(cur, w).unionByName(_scale_receipts(arc, w)).distinct()


def legacy_sums(pop_header: DataFrame, pop_line: DataFrame, keys: CodeKeys, cutoff: str = POP_CUTOFF, stage=None) -> DataFrame:
    """Legacy purchasing receipts before ``cutoff`` summed per item code.
    Quantity is extended cost / unit cost (unit cost 0 read as 1, NULL ratio
    as 0).  ``stage`` as in ``receipt_sums``."""
    d = keys.cut(pop_line.select("POPRCTNM", F.col("ITEMNMBR").alias("ItemCode"), "EXTDCOST", "UNITCOST"), "ItemCode")
    h = pop_header.filter(
        (F.col("POPTYPE") == POP_RECEIPT_TYPE) & (F.col("receiptdate") < ts_literal(cutoff))
    ).select("POPRCTNM", "receiptdate")
    unit = F.when(F.col("UNITCOST") == 0, F.lit(1)).otherwise(F.col("UNITCOST"))
    ratio = F.coalesce(F.col("EXTDCOST") / unit, F.lit(0)).cast("decimal(38,19)")
    f = meet_headers(d, h, "POPRCTNM", "receiptdate", stage)
    sums = f.groupBy("ItemCode").agg(
        F.min("_date").alias("RcvdDate"),
        F.sum(times(ratio, F.col(TIMES))).alias("_q"),
        F.sum(F.coalesce(F.col("EXTDCOST"), F.lit(0)) * F.col(TIMES)).cast(QTY).alias("_amt"),
    )
    return keys.exact(sums, "ItemCode")


def legacy_receipts_by_item(
    pop_header: DataFrame,
    pop_line: DataFrame,
    w: ItemWeights,
    cutoff: str = POP_CUTOFF,
    sums: DataFrame | None = None,
) -> DataFrame:
    """M9: legacy receipts per item; the quantity is truncated to int after
    the sum (and after scaling by the multiplicity)."""
    agg = sums if sums is not None else legacy_sums(pop_header, pop_line, w.keys, cutoff)
    j = agg.join(w.per_code(), "ItemCode")
    return j.select(
        "ItemCode",
        "RcvdDate",
        int_times(F.col("_q"), F.col("n")).alias("RcvdQty"),
        money(F.col("_amt") * F.col("n")).alias("RcvdAmt"),
    )


def consolidate_receipts(receipts: DataFrame, legacy: DataFrame) -> DataFrame:
    """One row per item over the receipt feeds: first date, summed
    quantity (int) and amount (money)."""
    return (
        receipts.select(*RECEIPT_COLS)
        .unionByName(legacy.select(*RECEIPT_COLS))
        .groupBy("ItemCode")
        .agg(
            F.min("RcvdDate").alias("RcvdDate"),
            to_int(F.sum("RcvdQty")).alias("RcvdQty"),
            money(F.sum("RcvdAmt")).alias("RcvdAmt"),
        )
    )
