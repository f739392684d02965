"""The tracked-item set (M1-M7).

The reference builds ``#items`` as a *bag*: joins on a shared report code
repeat rows, and every later fact join multiplies sums by those repeats
(Q7).  Here the bag is kept as distinct rows plus a multiplicity column
``n``: same information, without materialising the copies.  The pairs of a
shared-code family stay factorised (``FamilyRelation``) until the report's rows
are written; the re-added alias rows take the family size as a weight.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import key7, key20, pick_isbn
from tillroll.operators.bitmap_cut import cut_by_bitmap
from tillroll.operators.params import one_year_before, ts_literal
from tillroll.plans.strategy import bounded_broadcast, dealt, fits_broadcast, semi_join
from tillroll.sources.normalize import canonical_tables
from tillroll.fixed import ALIAS_PREFIX, REORDERABLE, TTB_LINE

ITEM_COLS = [
    "Title", "ItemCode", "ReportItemCode", "ISBN", "Cost", "Price", "MSRP",
    "SectionCode", "VendorID", "OrgPO", "OrgBuyer",
]
WEIGHT = "n"


def _ttb(pm: DataFrame) -> DataFrame:
    return pm.filter(F.col("UserChar15") == TTB_LINE)


def product_rows(pm: DataFrame, pmd: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Product x distribution rows with the item attributes.

    ``MasterCode`` is the 20-character code, ``ItemCode`` its short form,
    ``RawReport`` the distribution report code as stored (may be NULL) and
    ``ReportItemCode`` that code defaulted to the product's own code.
    ``keep`` names extra product columns to carry along.
    """
    p = pm.select("ItemCode", "Title", "ISBN", "Cost", "Price", "MfgSuggestedPrice", "SectionCode", "VendorID", *keep)
    d = pmd.select("ItemCode", F.col("ReportItemCode").alias("RawReport"), "UPC")
    return p.join(dealt(d), "ItemCode").select(
        *keep,
        F.col("ItemCode").alias("MasterCode"),
        "Title",
        key7(F.col("ItemCode")).alias("ItemCode"),
        "RawReport",
        F.coalesce(F.col("RawReport"), F.col("ItemCode")).alias("ReportItemCode"),
        pick_isbn(F.col("ISBN"), F.col("UPC")).alias("ISBN"),
        "Cost",
        "Price",
        F.col("MfgSuggestedPrice").alias("MSRP"),
        "SectionCode",
        "VendorID",
    )


def recent_oos_codes(oos_log: DataFrame, as_of) -> DataFrame:
    """Padded codes whose latest out-of-stock entry is within the year
    before ``as_of`` (the HAVING max(runtime) > as_of - 1 year of the
    reference).  ``max(runtime) > bound`` holds exactly when some entry is
    after the bound, so the log is filtered first -- the range reaches the
    scan and only the last year is read -- then deduplicated map-side."""
    bound = ts_literal(one_year_before(as_of))
    return (
        oos_log.filter(F.col("runtime") > bound)
        .select(key20(F.col("Item")).alias("MasterCode"))
        .distinct()
    )


def first_po(order_detail: DataFrame, master_codes: DataFrame, rows: int | None = None) -> DataFrame:
    """Lowest PO number per master code, for the given codes only.

    Order lines are cut to the wanted codes before aggregating (broadcast
    semi join under the row bound, else a bitmap, and the shuffle semi join of
    what is aggregated); ``min`` aggregates map-side.  ``rows`` is a known upper bound on the codes.
    """
    keys = master_codes.select(F.col("MasterCode").alias("ItemCode")).filter(F.col("ItemCode").isNotNull()).distinct()
    od, small = order_detail.select("ItemCode", "PONumber"), fits_broadcast(keys, rows)
    od = semi_join(od, keys, "ItemCode", True) if small else cut_by_bitmap(od, keys, ["ItemCode"])
    po = od.groupBy("ItemCode").agg(F.min("PONumber").alias("OrgPO"))
    if not small:
        po = semi_join(po, keys, "ItemCode", False)
    return po.withColumnRenamed("ItemCode", "MasterCode")


def _with_po(rows: DataFrame, po: DataFrame) -> DataFrame:
    return rows.join(dealt(po), "MasterCode", "left").withColumn("OrgBuyer", F.lit(""))


def line_rows(pm: DataFrame, pmd: DataFrame) -> DataFrame:
    """Product rows of the product line (with the reorderable flag): the
    input of M1, M3 and M4."""
    return product_rows(_ttb(pm), pmd, keep=("Reorderable",))


def reorderable_items(line: DataFrame, po: DataFrame) -> DataFrame:
    """M1: distinct attribute rows of reorderable items in the product line.
    ``line`` is ``line_rows``; ``po`` maps MasterCode -> OrgPO (``first_po``)."""
    rows = line.filter(F.col("Reorderable") == REORDERABLE)
    return _with_po(rows, po).select(*ITEM_COLS).distinct()


def alias_items(pm: DataFrame, pmd: DataFrame) -> DataFrame:
    """M2: product-line items that some product names as its 'UPC...' alias
    -> (ItemCode, ReportItemCode), one row per distribution row."""
    targets = (
        pm.filter(F.col("ItemAlias").startswith(ALIAS_PREFIX))
        .select(key20(F.replace(F.col("ItemAlias"), F.lit(ALIAS_PREFIX), F.lit(""))).alias("ItemCode"))
        .distinct()
    )
    ttb = _ttb(pm).select("ItemCode").join(bounded_broadcast(targets), "ItemCode", "left_semi")
    return ttb.join(dealt(pmd.select("ItemCode", "ReportItemCode")), "ItemCode")


def _alias_master_codes(upc: DataFrame) -> DataFrame:
    return upc.select(F.col("ItemCode").alias("MasterCode")).distinct()


ATTRIBUTES = [c for c in ITEM_COLS if c not in ("ItemCode", "ReportItemCode")]


@dataclass
class FamilyRelation:
    """M3 factorised: every product-line item that shares a report code with a
    reorderable item, with that item's attributes, plus the reorderables.

    A family (report code) of c codes and a attribute rows stands for c * a
    rows.  It is kept as its two sides, c + a rows; how often a code occurs and
    its highest cost follow from the sides, so the measures never read pairs.
    Only ``expand``, for the report's own rows, writes them out.
    """

    codes: DataFrame  # RawReport, ItemCode; distinct
    attributes: DataFrame  # RawReport and the attribute columns; distinct
    alone: DataFrame  # reorderable rows whose (report code, code) is not in ``codes``; distinct

    def expand(self) -> DataFrame:
        """The rows themselves, weighted (``n`` = 1).  Both sides are distinct
        and ``alone`` shares no (report code, code) with them: so is the union."""
        joined = self.codes.join(dealt(self.attributes), "RawReport").withColumnRenamed("RawReport", "ReportItemCode")
        rows = joined.select(*ITEM_COLS).unionByName(self.alone.select(*ITEM_COLS))
        return rows.withColumn(WEIGHT, F.lit(1).cast("bigint"))

    def per_code(self) -> DataFrame:
        """(ItemCode, n, max_cost): rows for each code, by family; codes in several families repeat."""
        sides = self.attributes.groupBy("RawReport").agg(
            F.count(F.lit(1)).alias(WEIGHT), F.max("Cost").alias("max_cost")
        )
        met = self.codes.join(sides, "RawReport").select("ItemCode", WEIGHT, "max_cost")
        return met.unionByName(self.alone.select("ItemCode", F.lit(1).cast("bigint").alias(WEIGHT), F.col("Cost").alias("max_cost")))

    def per_code_cost(self) -> DataFrame:
        """(ItemCode, Cost, n): as ``per_code``, for each cost in the family."""
        sides = self.attributes.groupBy("RawReport", "Cost").agg(F.count(F.lit(1)).alias(WEIGHT))
        met = self.codes.join(sides, "RawReport").select("ItemCode", "Cost", WEIGHT)
        return met.unionByName(self.alone.select("ItemCode", "Cost", F.lit(1).cast("bigint").alias(WEIGHT)))

    def item_codes(self) -> DataFrame:
        """The distinct codes of the rows."""
        met = self.codes.join(self.attributes.select("RawReport").distinct(), "RawReport", "left_semi")
        return met.select("ItemCode").unionByName(self.alone.select("ItemCode")).distinct()


def family_relation(cr: DataFrame, line: DataFrame, upc: DataFrame) -> FamilyRelation:
    """M3 from the reorderables, the product-line rows and the alias items (whose own codes stay out)."""
    codes = (
        line.filter(F.col("RawReport").isNotNull())
        .join(dealt(_alias_master_codes(upc)), "MasterCode", "left_anti")
        .select("RawReport", "ItemCode")
        .distinct()
    )
    attributes = cr.select(F.col("ReportItemCode").alias("RawReport"), *ATTRIBUTES).distinct()
    pairs = codes.withColumnRenamed("RawReport", "ReportItemCode")
    return FamilyRelation(codes, attributes, cr.select(*ITEM_COLS).join(dealt(pairs), ["ReportItemCode", "ItemCode"], "left_anti"))


def readd_alias_items(cr: DataFrame, line: DataFrame, upc: DataFrame, po: DataFrame) -> DataFrame:
    """M4: alias items of a reorderable family, with their own attributes.

    The reference inserts each such row once per reorderable row of the
    family (no dedup); the weight ``n`` is that family size.
    """
    rows = line.join(dealt(_alias_master_codes(upc)), "MasterCode", "left_semi")
    fam_size = cr.groupBy(F.col("ReportItemCode").alias("RawReport")).agg(F.count(F.lit(1)).alias(WEIGHT))
    rows = rows.join(fam_size, "RawReport")
    return _with_po(rows, po).groupBy(*ITEM_COLS).agg(F.sum(WEIGHT).alias(WEIGHT))


def flip_report_code(items: DataFrame, cr: DataFrame, cr_rows: int | None = None) -> DataFrame:
    """M5: for report codes where some reorderable's own code differs from
    the report code, set the report code to the highest reorderable code of
    that family (padded to 20)."""
    top = (
        cr.groupBy("ReportItemCode")
        .agg(
            F.max("ItemCode").alias("_top"),
            F.max(F.when(key20(F.col("ItemCode")) != key20(F.col("ReportItemCode")), F.lit(1))).alias("_flip"),
        )
        .filter(F.col("_flip") == 1)
        .select("ReportItemCode", "_top")
    )
    j = items.join(bounded_broadcast(top, cr_rows), "ReportItemCode", "left")
    new_code = F.when(F.col("_top").isNotNull(), key20(F.col("_top"))).otherwise(F.col("ReportItemCode"))
    return j.withColumn("ReportItemCode", new_code).select(*ITEM_COLS, WEIGHT)


def recent_out_of_stock(
    recent: DataFrame,
    pm: DataFrame,
    pmd: DataFrame,
    tracked: DataFrame,
    po: DataFrame,
    recent_rows: int | None = None,
) -> DataFrame:
    """M6: items logged out of stock within the year (``recent_oos_codes``)
    and not yet ``tracked`` (ItemCode), from any product line.  Distinct rows.  Products
    are cut to the logged codes before the product/distribution join."""
    codes = bounded_broadcast(recent.select(F.col("MasterCode").alias("ItemCode")), recent_rows)
    rows = product_rows(pm.join(codes, "ItemCode", "left_semi"), pmd)
    rows = rows.join(tracked.select("ItemCode").distinct(), "ItemCode", "left_anti")
    return _with_po(rows, po).select(*ITEM_COLS).distinct()


def attach_buyer(items: DataFrame, order_header: DataFrame, po_rows: int | None = None) -> DataFrame:
    """M7: OrgBuyer from the PO header of OrgPO.  A matched PO sets the
    buyer even when NULL; unmatched rows keep ''.  Several headers for one
    PO: the highest buyer id is taken (the reference leaves it undefined).
    ``po_rows`` bounds the number of distinct POs (e.g. the first-PO table's
    row count)."""
    pos = items.select(F.col("OrgPO").alias("PONumber")).distinct()
    heads = (
        order_header.select("PONumber", "BuyerID")
        .join(bounded_broadcast(pos, po_rows), "PONumber", "left_semi")
        .groupBy("PONumber")
        .agg(F.max("BuyerID").alias("_buyer"))
        .withColumn("_hit", F.lit(True))
    )
    j = items.join(heads, items["OrgPO"] == heads["PONumber"], "left")
    buyer = F.when(F.col("_hit"), F.col("_buyer")).otherwise(F.col("OrgBuyer"))
    return j.withColumn("OrgBuyer", buyer).select(*ITEM_COLS, WEIGHT)


def weighted(df: DataFrame) -> DataFrame:
    """Collapse identical rows, summing their multiplicities."""
    return df.groupBy(*ITEM_COLS).agg(F.sum(WEIGHT).alias(WEIGHT))


class ItemStages:
    """The item steps.  The weights of the item codes come from the factorised
    family; the expanded rows are planned, and written, on first use."""

    def __init__(self, stage, reorderables, alias, relation, readded, out_of_stock, order_header, rows, po_rows):
        self._stage = stage
        self.reorderables: DataFrame = reorderables  # M1
        self.alias: DataFrame = alias  # M2
        self.relation: FamilyRelation = relation  # M3, factorised
        self.readded: DataFrame = readded  # M4 (weighted)
        self.out_of_stock: DataFrame = out_of_stock  # M6
        self._order_header, self._rows, self._po_rows = order_header, rows, po_rows

    @cached_property
    def family(self) -> DataFrame:  # M3 (weighted)
        return self.relation.expand()

    @cached_property
    def flipped(self) -> DataFrame:  # M5 (weighted)
        rows = self.family.unionByName(self.readded)
        return self._stage(weighted(flip_report_code(rows, self.reorderables, self._rows)), "flipped")[0]

    @cached_property
    def items(self) -> DataFrame:  # M7 (weighted) -- the final tracked-item set
        one = F.lit(1).cast("bigint")
        rows = self.flipped.unionByName(self.out_of_stock.withColumn(WEIGHT, one))
        made = weighted(attach_buyer(rows, self._order_header, self._po_rows))
        made, self.items_rows = self._stage(made, "items")
        return made

    def per_code(self) -> DataFrame:
        """(ItemCode, n, max_cost), codes repeating: what the item set holds of each code, unexpanded."""
        own = self.readded.select("ItemCode", WEIGHT, F.col("Cost").alias("max_cost"))
        late = self.out_of_stock.select("ItemCode", F.lit(1).cast("bigint").alias(WEIGHT), F.col("Cost").alias("max_cost"))
        return self.relation.per_code().unionByName(own).unionByName(late)

    def per_code_cost(self) -> DataFrame:
        """(ItemCode, Cost, n), repeating, unexpanded."""
        late = self.out_of_stock.select("ItemCode", "Cost", F.lit(1).cast("bigint").alias(WEIGHT))
        return self.relation.per_code_cost().unionByName(self.readded.select("ItemCode", "Cost", WEIGHT)).unionByName(late)


def _identity(df: DataFrame, name: str) -> tuple[DataFrame, int | None]:
    return df, None


def build_items(tables, as_of, stage=None, on_candidates=None) -> ItemStages:
    """Run M1-M7.

    ``stage`` materialises an intermediate read more than once and returns
    it with its row count (``plans.stages.checkpointed``).  Without it every
    stage stays one lazy plan, and each reuse inlines the whole lineage
    again -- fine for a small test, not for a production run.  The first-PO
    table is computed once, for every code that can become an item
    (product-line codes and recently out-of-stock codes), so the order lines
    are scanned once.  ``on_candidates(codes, bound)`` is called with that
    candidate set (``MasterCode``) and a bound on its rows as soon as it is
    known, so fact roll-ups can start while the item steps continue.
    """
    stage = stage or _identity
    tables = canonical_tables(tables)
    pm, pmd, od = tables["product_master"], tables["product_master_dist"], tables["order_detail"]
    # The product-line rows and the recent out-of-stock codes are
    # independent: materialise them concurrently (two jobs in flight).
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_line = pool.submit(stage, line_rows(pm, pmd), "line")
        f_recent = pool.submit(stage, recent_oos_codes(tables["oos_item_log"], as_of), "recent")
        (line, line_n), (recent, recent_n) = f_line.result(), f_recent.result()
    candidates = line.select("MasterCode").unionByName(recent).distinct()
    bound = None if line_n is None or recent_n is None else line_n + recent_n
    if on_candidates is not None:
        on_candidates(candidates, bound)
    po, po_rows = stage(first_po(od, candidates, bound), "first-po")
    # The reorderable set is small and its size is bounded by the
    # product-line rows, so it stays a plan rather than another write.
    cr = reorderable_items(line, po)
    upc = alias_items(pm, pmd)
    relation = family_relation(cr, line, upc)
    readded, _ = stage(readd_alias_items(cr, line, upc, po), "readded")
    tracked = relation.item_codes().unionByName(readded.select("ItemCode"))
    oos, _ = stage(recent_out_of_stock(recent, pm, pmd, tracked, po, recent_n), "out-of-stock")
    return ItemStages(stage, cr, upc, relation, readded, oos, tables["order_header"], line_n, po_rows)
