"""The profit-by-title report rows (M15): items left-joined to the five
measures, 31 columns in report order, distinct."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import (
    date_text_or_na,
    money,
    money_pct_text,
    no_receipt_date,
    ratio_pct_text,
    to_int,
)
from tillroll.operators.items import ITEM_COLS
from tillroll.operators.params import as_datetime
from tillroll.plans.strategy import bounded_broadcast, dealt

REPORT_COLUMNS = [
    "ItemCode", "Title", "ISBN", "SectionCode", "VendorID", "Cost", "Price", "MSRP",
    "OrgBuyer", "OrgPO", "RcvdDate", "RcvdQty", "RcvdAmt", "WMSAvailQty",
    "NetTTBSoldQty", "TTBSoldAmt", "TTBAvgSoldAmt", "TTBAvgPrf", "TTBAvgDisc",
    "TTBAvgDiscPct", "NetHPBSoldQty", "HPBMRKDQty", "HPBMRKDPct", "HPBSoldAmt",
    "HPBAvgSoldAmt", "HPBShipQty", "HPBShipAmt", "NetTotalSold", "TotalAmt",
    "GrossProfit", "UpdateDate",
]


def _zero() -> F.Column:
    return F.lit(Decimal(0))


def profit_rows(
    items: DataFrame,
    receipts: DataFrame,
    store_ship: DataFrame,
    store_sales: DataFrame,
    wholesale: DataFrame,
    wms: DataFrame,
    as_of,
    money_mode: str = "half_up",
    items_rows: int | None = None,
) -> DataFrame:
    """M15.  ``items`` is the weighted item set (distinct rows; the weight
    column is not needed here).  Measures are at most a few rows per item,
    so the chain of left joins runs on item-sized inputs; stock rows are cut
    to the item codes (broadcast semi join under the row bound) first."""
    i = items.select(*ITEM_COLS)
    r = receipts.select(
        "ItemCode", F.col("RcvdDate").alias("r_date"), F.col("RcvdQty").alias("r_qty"), F.col("RcvdAmt").alias("r_amt")
    )
    ship = store_ship.select(
        "ItemCode", F.col("HPBShipQty").alias("sh_qty"), F.col("HPBShipAmt").alias("sh_amt")
    )
    ss = store_sales.select(
        "ItemCode",
        F.col("HPBSoldQty").alias("ss_qty"),
        F.col("HPBSoldAmt").alias("ss_amt"),
        F.col("HPBAvgSoldAmt").alias("ss_avg"),
        F.col("HPBmarkdowns").alias("ss_md"),
    )
    ws = wholesale.select(
        F.col("ITEMNMBR").alias("ItemCode"),
        F.col("TTBSoldQty").alias("ws_qty"),
        F.col("TTBSoldAmt").alias("ws_amt"),
        F.col("TTBAvgSoldAmt").alias("ws_avg"),
    )
    keys = i.select("ItemCode").distinct()
    w = wms.select(F.col("ITEM").alias("ItemCode"), F.col("AvailableQty").alias("w_qty")).join(
        bounded_broadcast(keys, items_rows), "ItemCode", "left_semi"
    )
    # Each measure grows with the items: none passes the driver.  All joins
    # are on the item code, so the items are exchanged once for the chain.
    j = (
        i.join(dealt(r), "ItemCode", "left")
        .join(dealt(ship), "ItemCode", "left")
        .join(dealt(ss), "ItemCode", "left")
        .join(dealt(ws), "ItemCode", "left")
        .join(dealt(w), "ItemCode", "left")
    )

    c = F.col
    no_date = no_receipt_date(c("r_date"))
    ship_q = to_int(F.coalesce(c("sh_qty"), F.lit(0)))
    ws_q = to_int(F.coalesce(c("ws_qty"), _zero()))
    ws_amt = F.coalesce(c("ws_amt"), _zero())
    ss_amt = F.coalesce(c("ss_amt"), _zero())
    avg_m = money(F.coalesce(c("ws_avg"), _zero()))
    stock_cost = money(
        (F.coalesce(c("w_qty"), F.lit(0)) * c("Cost")) + (ship_q * c("Cost")) + (ws_q * c("Cost"))
    )
    hpb_q = to_int(F.coalesce(c("ss_qty"), _zero()))
    ttb_zero = ws_q == 0
    as_of_text = as_datetime(as_of).strftime("%Y-%m-%d %H:%M:%S")

    out = j.select(
        "ItemCode", "Title", "ISBN", "SectionCode", "VendorID", "Cost", "Price", "MSRP", "OrgBuyer", "OrgPO",
        date_text_or_na(c("r_date")).alias("RcvdDate"),
        F.coalesce(
            F.when(no_date, c("w_qty") + ship_q + ws_q).otherwise(F.coalesce(c("r_qty"), F.lit(0))), F.lit(0)
        ).alias("RcvdQty"),
        money(
            F.coalesce(F.when(no_date, stock_cost).otherwise(F.coalesce(c("r_amt"), _zero())), _zero())
        ).alias("RcvdAmt"),
        F.coalesce(c("w_qty"), F.lit(0)).alias("WMSAvailQty"),
        ws_q.alias("NetTTBSoldQty"),
        money(ws_amt).alias("TTBSoldAmt"),
        avg_m.alias("TTBAvgSoldAmt"),
        money(F.when(ttb_zero, _zero()).otherwise(avg_m - c("Cost"))).alias("TTBAvgPrf"),
        money(F.when(ttb_zero, _zero()).otherwise(c("Price") - avg_m)).alias("TTBAvgDisc"),
        money_pct_text(c("Price") - avg_m, c("Price"), ttb_zero | (c("Price") == 0), money_mode).alias("TTBAvgDiscPct"),
        hpb_q.alias("NetHPBSoldQty"),
        to_int(F.coalesce(c("ss_md"), F.lit(0))).alias("HPBMRKDQty"),
        ratio_pct_text(F.coalesce(c("ss_md"), F.lit(0)), F.coalesce(c("ss_qty"), _zero()), hpb_q == 0).alias("HPBMRKDPct"),
        money(ss_amt).alias("HPBSoldAmt"),
        money(F.coalesce(c("ss_avg"), _zero())).alias("HPBAvgSoldAmt"),
        ship_q.alias("HPBShipQty"),
        money(F.coalesce(c("sh_amt"), _zero())).alias("HPBShipAmt"),
        to_int(F.coalesce(c("ws_qty"), _zero()) + F.coalesce(c("ss_qty"), _zero())).alias("NetTotalSold"),
        money(ws_amt + ss_amt).alias("TotalAmt"),
        money(
            F.coalesce(
                F.when(no_date, (ws_amt + ss_amt) - stock_cost).otherwise(
                    money((ws_amt + ss_amt) - F.coalesce(c("r_amt"), _zero()))
                ),
                _zero(),
            )
        ).alias("GrossProfit"),
        F.lit(as_of_text).cast("timestamp_ntz").alias("UpdateDate"),
    )
    return out.distinct()
