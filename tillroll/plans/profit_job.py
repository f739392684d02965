"""Entry point: the profit-by-title roll-up and its report sink.

Stage plan: the item codes with their multiplicities (written once: seven fact
joins read them), each fact feed rolled up per item code, the item rows, then
left joins of the measures to the items.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import key7

from tillroll.operators import receipts as R
from tillroll.operators import sales as SA
from tillroll.operators.items import ItemStages, build_items
from tillroll.operators.profit import REPORT_COLUMNS, profit_rows
from tillroll.operators.weights import code_keys, stage_weights
from tillroll.plans.report_store import Commit, ReportStore
from tillroll.plans.stages import checkpointed, discard, release
from tillroll.sources.normalize import canonical_tables
from tillroll.sources.tables import Tables


SUMMED_AT_ONCE = 2  # feeds whose lines and shuffle files are on disk at the same time
FEEDS = ("receipts", "archive", "legacy", "transfers", "sales", "open orders", "order history")


class ProfitRun:
    """Every stage of one run, for audits and traces (the debug script's view
    of the job).  The item codes and their weights are made up front.  A fact
    feed is summed when a measure first asks for it, unless ``feeds`` names it:
    those start in the background as soon as the codes that can become items
    are known.  The expanded item rows are made for the report alone."""

    def __init__(self, tables: Tables, as_of, fanout: str, money_mode: str, reuse: bool, feeds: tuple[str, ...] = (), stage=None):
        self._t = tables = canonical_tables(tables)
        self.as_of = as_of
        self.money_mode = money_mode
        self._reuse = reuse
        self._stage = stage or checkpointed
        self._pool = ThreadPoolExecutor(max_workers=SUMMED_AT_ONCE)
        self._sums: dict[str, Future] = {}
        self._keys = None
        codes_bound = None

        def candidates_known(candidates: DataFrame, bound: int | None) -> None:
            # Fact roll-ups need only the codes that can become items; the
            # multiplicity join later keeps only real item codes.
            nonlocal codes_bound
            codes_bound = bound
            if reuse:
                self._keys = code_keys(candidates.select(key7(F.col("MasterCode")).alias("ItemCode")), bound)
                self._start(feeds)

        self.items: ItemStages = build_items(tables, as_of, self._stage if reuse else None, candidates_known)
        self.weights = stage_weights(self.items, fanout, codes_bound)
        if reuse:
            kept = {c: self._stage(getattr(self.weights, c), c)[0] for c in ("by_code", "by_code_cost")}
            self.weights = replace(self.weights, **kept)

    def _start(self, feeds: Iterable[str]) -> None:
        t, keys = self._t, self._keys

        def lines(feed, written):
            def stage(df):
                written.append(self._stage(df, f"lines-{feed}"))
                return written[-1]

            return stage

        makers = {
            "receipts": lambda st: R.receipt_sums(t["receipt_header"], t["receipt_detail"], keys, st),
            "archive": lambda st: R.receipt_sums(t["ar_receipt_header"], t["ar_receipt_detail"], keys, st),
            "legacy": lambda st: R.legacy_sums(t["pop_receipt_header"], t["pop_receipt_line"], keys, stage=st),
            "transfers": lambda st: SA.shipment_sums(t["transfer_header"], t["transfer_detail"], keys, st),
            "sales": lambda st: SA.sales_sums(t["sales_item_history"], t["locations"], keys),
            "open orders": lambda st: SA.wholesale_sums(t["sop_open_header"], t["sop_open_line"], keys, st),
            "order history": lambda st: SA.wholesale_sums(t["sop_hist_header"], t["sop_hist_line"], keys, st),
        }

        def summed(name):
            feed, written = name.replace(" ", "-"), []
            sums = self._stage(makers[name](lines(feed, written)), f"feed-{feed}")[0]
            if self._stage is checkpointed:  # a catalog's stages are kept for a run that resumes
                for table, _ in written:
                    discard(table)
            release(sums.sparkSession)
            return sums

        for name in feeds:
            if name not in self._sums:
                self._sums[name] = self._pool.submit(summed, name)

    def _s(self, *names):
        if not self._reuse:
            return None
        self._start(names)
        got = tuple(self._sums[n].result() for n in names)
        return got if len(got) > 1 else got[0]

    @cached_property
    def receipts_feeds(self) -> DataFrame:  # M8
        t = self._t
        return R.receipts_by_item(
            t["receipt_header"], t["receipt_detail"], t["ar_receipt_header"], t["ar_receipt_detail"], self.weights,
            self._s("receipts", "archive"),
        )

    @cached_property
    def legacy_receipts(self) -> DataFrame:  # M9
        return R.legacy_receipts_by_item(
            self._t["pop_receipt_header"], self._t["pop_receipt_line"], self.weights, sums=self._s("legacy")
        )

    @cached_property
    def receipts(self) -> DataFrame:  # M10
        return R.consolidate_receipts(self.receipts_feeds, self.legacy_receipts)

    @cached_property
    def store_ship(self) -> DataFrame:  # M11
        return SA.store_shipments_by_item(
            self._t["transfer_header"], self._t["transfer_detail"], self.weights, self._s("transfers")
        )

    @cached_property
    def store_sales(self) -> DataFrame:  # M12
        return SA.retail_sales_by_item(self._t["sales_item_history"], self._t["locations"], self.weights, self._s("sales"))

    @cached_property
    def wholesale_feeds(self) -> DataFrame:  # M13
        t = self._t
        return SA.wholesale_sales_by_item(
            t["sop_open_header"], t["sop_open_line"], t["sop_hist_header"], t["sop_hist_line"], self.weights,
            self._s("open orders", "order history"),
        )

    @cached_property
    def wholesale(self) -> DataFrame:  # M14
        return SA.consolidate_wholesale(self.wholesale_feeds)

    @cached_property
    def report(self) -> DataFrame:  # M15
        if self._reuse:
            self._start(FEEDS)
        items = self.items.items
        return profit_rows(
            items,
            self.receipts,
            self.store_ship,
            self.store_sales,
            self.wholesale,
            self._t["wms_available_qty"],
            self.as_of,
            self.money_mode,
            self.items.items_rows,
        )


def run_profit(
    tables: Tables,
    as_of,
    fanout: str = "reference",
    money_mode: str = "half_up",
    reuse: bool = True,
    feeds: tuple[str, ...] = (),
    stage=None,
) -> ProfitRun:
    """Make the item codes and weights (written when ``reuse``) and return the
    run.  Measures and the report are planned on first access; ``feeds`` (of
    ``FEEDS``) are summed in background jobs from the start.  ``stage`` writes the
    stages (default ``checkpointed``; ``StageCatalog.stage`` finds those of a failed run)."""
    return ProfitRun(tables, as_of, fanout, money_mode, reuse, feeds, stage)


def profit_by_title(tables: Tables, as_of, fanout: str = "reference", money_mode: str = "half_up", reuse: bool = True) -> DataFrame:
    """The 31-column report rows (a dry run: nothing is written)."""
    return run_profit(tables, as_of, fanout, money_mode, reuse, FEEDS).report


def refresh_report(report: DataFrame, base: str, version: str | None = None, keep: int | None = None, rebase: bool = False) -> Commit:
    """Full refresh of the stored report; see ``ReportStore`` for its commit.

    ``version`` is a label kept with the commit.  ``keep`` removes all but the
    newest commits after this one.
    """
    store = ReportStore(report.sparkSession, base)
    commit = store.write(report.select(*REPORT_COLUMNS), version, rebase=rebase)
    if keep is not None:
        store.expire(keep)
    return commit


def read_report(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """The stored report as of the newest commit (or of an older one that is kept)."""
    return ReportStore(spark, base).read(number)
