"""Store shipments, retail and wholesale sales per item."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import MONEY, money, to_int
from tillroll.operators.documents import TIMES, meet_headers
from tillroll.operators.weights import CodeKeys, ItemWeights
from tillroll.plans.strategy import bounded_broadcast
from tillroll.sources.normalize import canonical, fold_text
from tillroll.fixed import (
    ACTIVE_STATUS,
    INTERNAL_CUSTOMER_PREFIXES,
    INTERNAL_CUSTOMERS,
    NOT_RETURN_FLAG,
    RETAIL_FLAG,
    RETURN_FLAG,
    SALE_TYPE,
    SOP_DOC_ID,
    SOP_INVOICE_TYPE,
    SOP_VOID_BATCH,
    STORE_NO_RANGE,
)

QTY = "decimal(38,5)"
AVG = "decimal(38,6)"


def shipment_sums(transfer_header: DataFrame, transfer_detail: DataFrame, keys: CodeKeys, stage=None) -> DataFrame:
    """Store-shipment quantity summed per padded item code.  ``stage`` writes the lines cut to the codes once."""
    d = keys.cut(transfer_detail.select("TransferID", F.col("ItemCode").alias("Code20"), "Qty"), "Code20", padded=True)
    f = meet_headers(d, transfer_header, "TransferID", stage=stage)
    return keys.exact(f.groupBy("Code20").agg(F.sum(F.col("Qty") * F.col(TIMES)).cast(QTY).alias("_q")), "Code20", padded=True)


def store_shipments_by_item(
    transfer_header: DataFrame, transfer_detail: DataFrame, w: ItemWeights, sums: DataFrame | None = None
) -> DataFrame:
    """Shipped quantity (int) and cost-valued amount per (item, cost);
    distinct output rows, so one item may have a row per cost."""
    agg = sums if sums is not None else shipment_sums(transfer_header, transfer_detail, w.keys)
    j = agg.join(w.per_code_cost(), "Code20")
    q = F.col("_q") * F.col("n")
    return j.select(
        "ItemCode",
        to_int(q).alias("HPBShipQty"),
        money(q * F.col("Cost")).alias("HPBShipAmt"),
    ).distinct()


def retail_stores(locations: DataFrame) -> DataFrame:
    """Active retail stores whose number is an integer within the range."""
    lo, hi = STORE_NO_RANGE
    return canonical(locations, "locations").filter(
        (F.col("RetailStore") == RETAIL_FLAG)
        & (F.col("Status") == ACTIVE_STATUS)
        & F.col("LocationNo").try_cast("int").between(lo, hi)
    ).select("LocationID")


def sales_sums(sales: DataFrame, locations: DataFrame, keys: CodeKeys) -> DataFrame:
    """Register sales at retail stores summed per padded item code: net
    quantity (a NULL return flag counts as a sale), amount, amount count,
    markdown count."""
    s = (
        canonical(sales, "sales_item_history")
        .filter(F.col("XactionType") == SALE_TYPE)
        .select(
            "LocationID",
            F.col("ItemCode").alias("Code20"),
            "isreturn",
            "quantity",
            "ExtendedAmt",
            "unitprice",
            "registerprice",
        )
    )
    s = keys.cut(s, "Code20", padded=True).join(bounded_broadcast(retail_stores(locations)), "LocationID")
    signed = F.when(F.col("isreturn") == RETURN_FLAG, -F.col("quantity")).otherwise(F.col("quantity"))
    marked = F.when(
        (F.col("unitprice") > F.col("registerprice")) & (F.col("isreturn") == NOT_RETURN_FLAG), 1
    ).otherwise(0)
    sums = s.groupBy("Code20").agg(
        F.sum(signed).alias("_sq"),
        F.sum("ExtendedAmt").alias("_amt"),
        F.count("ExtendedAmt").alias("_cnt"),
        F.sum(marked).alias("_md"),
    )
    return keys.exact(sums, "Code20", padded=True)


def retail_sales_by_item(sales: DataFrame, locations: DataFrame, w: ItemWeights, sums: DataFrame | None = None) -> DataFrame:
    """Register sales at retail stores: net quantity, amount, average
    amount, markdown count per item."""
    agg = sums if sums is not None else sales_sums(sales, locations, w.keys)
    j = agg.join(w.per_code(), "Code20")
    n = F.col("n")
    return j.select(
        "ItemCode",
        F.coalesce(F.col("_sq") * n, F.lit(0)).cast(QTY).alias("HPBSoldQty"),
        money(F.col("_amt") * n).alias("HPBSoldAmt"),
        F.when(F.col("_cnt") > 0, money(F.col("_amt").cast(MONEY) / F.col("_cnt"))).alias("HPBAvgSoldAmt"),
        to_int(F.col("_md") * n).alias("HPBmarkdowns"),
    )


def wholesale_orders(header: DataFrame) -> DataFrame:
    """Invoiced standard wholesale documents to outside customers (a NULL
    customer or batch drops out, as NOT IN / NOT LIKE / <> do)."""
    c = F.col("CUSTNMBR")
    keep = (
        (F.col("SOPTYPE") == SOP_INVOICE_TYPE)
        & ~c.isin(*INTERNAL_CUSTOMERS)
        & (F.col("DOCID") == SOP_DOC_ID)
        & (F.col("BCHSOURC") != fold_text(SOP_VOID_BATCH))
    )
    for prefix in INTERNAL_CUSTOMER_PREFIXES:
        keep = keep & ~c.startswith(prefix)
    return canonical(header, "sop_open_header").filter(keep).select("SOPNUMBE")


def wholesale_sums(header: DataFrame, lines: DataFrame, keys: CodeKeys, stage=None) -> DataFrame:
    """One wholesale feed (open or history) summed per item code.  ``stage`` writes the lines cut to the codes once."""
    d = keys.cut(lines.select("SOPNUMBE", F.col("ITEMNMBR").alias("ItemCode"), "QTYTOINV", "XTNDPRCE"), "ItemCode")
    f = meet_headers(d, wholesale_orders(header), "SOPNUMBE", stage=stage)
    sums = f.groupBy("ItemCode").agg(
        F.sum(F.col("QTYTOINV") * F.col(TIMES)).cast(QTY).alias("_q"),
        F.sum(F.col("XTNDPRCE") * F.col(TIMES)).cast(QTY).alias("_a"),
    )
    return keys.exact(sums, "ItemCode")


def _scale_wholesale(sums: DataFrame, w: ItemWeights) -> DataFrame:
    j = sums.join(w.per_code(), "ItemCode")
    q = (F.col("_q") * F.col("n")).cast(QTY)
    a = (F.col("_a") * F.col("n")).cast(QTY)
    return j.select(
        F.col("ItemCode").alias("ITEMNMBR"),
        q.alias("TTBSoldQty"),
        a.alias("TTBSoldAmt"),
        F.when(q == 0, F.lit(Decimal(0))).otherwise(a / q).cast(AVG).alias("TTBAvgSoldAmt"),
    )


def wholesale_sales_by_item(
    open_header: DataFrame,
    open_lines: DataFrame,
    hist_header: DataFrame,
    hist_lines: DataFrame,
    w: ItemWeights,
    sums: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Per item and feed (open, history): quantity, amount and average
    price (0 when the quantity sums to 0); the feeds are set-unioned."""
    o, h = sums or (wholesale_sums(open_header, open_lines, w.keys), wholesale_sums(hist_header, hist_lines, w.keys))
    return _scale_wholesale(o, w).unionByName(_scale_wholesale(h, w)).distinct()


def consolidate_wholesale(feeds: DataFrame) -> DataFrame:
    """Per item, summed quantity and amount, and the *unweighted* mean
    of the feeds' average prices."""
    return feeds.groupBy("ITEMNMBR").agg(
        F.sum("TTBSoldQty").cast(QTY).alias("TTBSoldQty"),
        F.sum("TTBSoldAmt").cast(QTY).alias("TTBSoldAmt"),
        F.when(
            F.count("TTBAvgSoldAmt") > 0,
            F.sum("TTBAvgSoldAmt") / F.count("TTBAvgSoldAmt"),
        ).cast(AVG).alias("TTBAvgSoldAmt"),
    )
