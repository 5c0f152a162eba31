"""The dossier: every output of every campaign as a DataFrame.

``Dossier(tables)`` wires the operators; ``dossier.query(key)``, or the
attribute of that name, returns one output with doubles.  ``dossier.exact``
has the same frames with exact decimals, from which later ones are computed.

Frames are lazy but for six tables that many plans start from.  They are
written to the checkpoint folder when a plan that needs them is built, so
building one runs Spark jobs: the receipts and shipments of all listed
campaigns, the campaign facts (one row per campaign), the article -> reference
map (a dimension), the purchase prices by reference and,
for the grid family only, the by-reference flows and their numbered dates.  No
plan hints a broadcast: the planner and AQE decide from sizes in bytes.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from orderflow.functions.exprs import CAMPAIGN, doubles
from orderflow.operators import byref, campaign, delivery, details, grid, orders, rebucket, refmap, summary, valuation
from orderflow.session import bounded_tasks, stored
from orderflow.sources.tables import DomainTables

QUERY_KEYS = [
    "campaigns", "campaign_status", "article_ref_map",
    "purchase_lines", "purchase_order_keys", "sales_lines", "sales_order_keys",
    "receipts_daily", "shipments", "purchase_price_by_ref", "releases_valued", "cancellations_valued",
    "campaign_totals", "campaign_summary",
    "purchases_by_ref_date", "releases_by_ref_date", "receipts_by_ref_date", "shipments_by_ref_date",
    "pct_releases", "pct_receipts", "pct_shipments",
    "ref_universe", "movement_dates", "ref_date_grid", "movements_on_grid",
    "cumulative_by_date", "pct_cum_by_date",
    "next_release_date", "by_release_date", "pct_cum_by_release_date",
    "release_to_receipt_delay", "late_deliveries",
    "receipts_with_catalogue", "shipments_with_catalogue", "duplicate_release_alerts",
]

# Outputs written by the sink job that are not separate queries.
SINK_ONLY_KEYS = ["campaigns_produced"]


class Dossier:
    def __init__(self, tables: DomainTables, materialize: bool = True):
        self.t = tables.guard()
        self.spark = tables.campaigns.sparkSession
        bounded_tasks(self.spark)
        self.exact = ExactDossier(self.t, materialize)

    def query(self, key: str) -> DataFrame:
        if key not in QUERY_KEYS and key not in SINK_ONLY_KEYS:
            raise KeyError(key)
        return doubles(getattr(self.exact, key))

    def __getattr__(self, key: str) -> DataFrame:
        if key in QUERY_KEYS or key in SINK_ONLY_KEYS:
            return self.query(key)
        raise AttributeError(key)


class ExactDossier:
    """All frames, sums as exact decimals."""

    def __init__(self, tables: DomainTables, materialize: bool = True):
        self.t = tables.guard()
        self.materialize = materialize

    def _stored(self, df: DataFrame) -> DataFrame:
        return stored(df) if self.materialize else df

    def scoped(self, df: DataFrame) -> DataFrame:
        """Keep the rows of campaigns whose dossier is produced."""
        return df.join(self.produced.select(*CAMPAIGN), CAMPAIGN, "left_semi")

    # ---- dimension -----------------------------------------------------
    @cached_property
    def catalogues(self) -> DataFrame:
        return orders.campaign_catalogues(self.t.campaigns)

    @cached_property
    def campaigns(self) -> DataFrame:
        return self.catalogues

    @cached_property
    def article_ref_map(self) -> DataFrame:
        """Article dimension -> references, read by every flow."""
        return self._stored(refmap.article_ref_map(self.t.article, self.t.couleur, self.t.article_pack))

    @cached_property
    def lookup(self) -> DataFrame:
        return refmap.rfc_lookup(self.article_ref_map)

    # ---- raw flows (all campaigns of the parameter table) ---------------
    @cached_property
    def _purchases_all(self) -> DataFrame:
        return orders.purchase_lines(self.t.commande_achat, self.catalogues, self.t.article)

    @cached_property
    def _sales_rows_all(self) -> DataFrame:
        return orders.sales_rows(self.t.commande_vente, self.catalogues)

    @cached_property
    def _receipts_all(self) -> DataFrame:
        """Stored: the campaign facts and the by-reference flows start from it."""
        return self._stored(orders.receipts_daily(orders.receipt_rows(
            self.t.mouvement, orders.purchase_order_keys(self._purchases_all), self.t.article)))

    @cached_property
    def _shipments_all(self) -> DataFrame:
        """Stored, as the receipts."""
        return self._stored(orders.shipments(self.t.mouvement, orders.sales_order_keys(self._sales_rows_all), self.t.article))

    # ---- campaign facts --------------------------------------------------
    @cached_property
    def facts(self) -> DataFrame:
        """Status, flags and totals of every listed campaign."""
        return self._stored(campaign.campaign_facts(
            self.t.campaigns, self._purchases_all, self.t.releases, self.t.cancellations, self._receipts_all, self._shipments_all,
            self.lookup))

    @cached_property
    def hashes(self) -> DataFrame:
        """A hash of the inputs of every listed campaign: equal inputs give equal outputs."""
        receipts = orders.receipt_rows(self.t.mouvement, orders.purchase_order_keys(self._purchases_all), self.t.article)
        shipped = orders.shipments(self.t.mouvement, orders.sales_order_keys(self._sales_rows_all), self.t.article)
        return campaign.campaign_hashes(self.t.campaigns, self._purchases_all, self._sales_rows_all, self.t.releases,
                                        self.t.cancellations, receipts, shipped, self.lookup)

    @cached_property
    def produced(self) -> DataFrame:
        return self.facts.where("status = 'ok'")

    @cached_property
    def campaign_status(self) -> DataFrame:
        return campaign.campaign_status(self.facts)

    @cached_property
    def campaigns_produced(self) -> DataFrame:
        """Parameter rows, all their columns, of the campaigns whose dossier is produced."""
        return self.scoped(self.t.campaigns)

    # ---- flows of produced campaigns -------------------------------------
    @cached_property
    def purchase_lines(self) -> DataFrame:
        return self.scoped(self._purchases_all)

    @cached_property
    def purchase_order_keys(self) -> DataFrame:
        return orders.purchase_order_keys(self.purchase_lines)

    @cached_property
    def _sales_rows(self) -> DataFrame:
        return self.scoped(self._sales_rows_all)

    @cached_property
    def sales_lines(self) -> DataFrame:
        return orders.sales_lines(self._sales_rows)

    @cached_property
    def sales_order_keys(self) -> DataFrame:
        return orders.sales_order_keys(self._sales_rows)

    @cached_property
    def receipts_daily(self) -> DataFrame:
        return orders.receipts_daily(orders.receipt_rows(self.t.mouvement, self.purchase_order_keys, self.t.article))

    @cached_property
    def shipments(self) -> DataFrame:
        return orders.shipments(self.t.mouvement, self.sales_order_keys, self.t.article)

    @cached_property
    def purchase_price_by_ref(self) -> DataFrame:
        """Stored: every output of releases and cancellations is valued from it."""
        return self._stored(self._prices)

    @cached_property
    def _prices(self) -> DataFrame:
        return valuation.purchase_price_by_ref(self.purchase_lines, self.lookup)

    @cached_property
    def releases_valued(self) -> DataFrame:
        return valuation.releases_valued(self.scoped(self.t.releases), self.purchase_price_by_ref)

    @cached_property
    def cancellations_valued(self) -> DataFrame:
        return valuation.cancellations_valued(self.scoped(self.t.cancellations), self.purchase_price_by_ref)

    # ---- totals and summary ----------------------------------------------
    @cached_property
    def campaign_totals(self) -> DataFrame:
        return campaign.campaign_totals(self.facts)

    @cached_property
    def campaign_summary(self) -> DataFrame:
        valued = valuation.valued_totals(self.scoped(self.t.releases), self.scoped(self.t.cancellations),
                                         self.purchase_price_by_ref)
        return summary.campaign_summary(self.facts, valued)

    # ---- by reference and date -------------------------------------------
    @cached_property
    def purchases_by_ref_date(self) -> DataFrame:
        return byref.flow_by_ref_date(self.purchase_lines, self.lookup, byref.PURCHASE)

    def _family(self, family: str, flow: DataFrame) -> DataFrame:
        return byref.flow_by_ref_date(flow, self.lookup, byref.FLOWS[family])

    @cached_property
    def releases_by_ref_date(self) -> DataFrame:
        return self._family("release", self.releases_valued)

    @cached_property
    def receipts_by_ref_date(self) -> DataFrame:
        return self._family("receipt", self.receipts_daily)

    @cached_property
    def shipments_by_ref_date(self) -> DataFrame:
        return self._family("shipment", self.shipments)

    def _shares(self, family: str, flow: DataFrame) -> DataFrame:
        _, qty, amount = byref.FLOWS[family]
        return byref.with_pct(flow, self.campaign_totals, [qty], [amount])

    @cached_property
    def pct_releases(self) -> DataFrame:
        return self._shares("release", self.releases_by_ref_date)

    @cached_property
    def pct_receipts(self) -> DataFrame:
        return self._shares("receipt", self.receipts_by_ref_date)

    @cached_property
    def pct_shipments(self) -> DataFrame:
        return self._shares("shipment", self.shipments_by_ref_date)

    # ---- grid and running totals -----------------------------------------
    @cached_property
    def _flows(self) -> DataFrame:
        """By-reference flows of all families, sparse; the grid family starts from them.  A family's sums are stored before
        they meet the others', so the shuffles of one family at a time are on disk."""
        keyed = {"release": self.releases_valued, "receipt": self.scoped(self._receipts_all), "shipment": self.scoped(self._shipments_all)}
        return self._stored(byref.side_by_side(
            [self._stored(byref.family_sums(byref.keyed_rows(flow, self.lookup, byref.FLOWS[fam][0]), fam)) for fam, flow in keyed.items()]))

    @cached_property
    def ref_universe(self) -> DataFrame:
        ordered = byref.keyed_rows(self.purchase_lines, self.lookup, byref.PURCHASE[0])
        return grid.ref_universe([ordered, self._flows])

    @cached_property
    def _dates(self) -> DataFrame:
        """The movement dates of every campaign, numbered."""
        return self._stored(grid.numbered_dates(self._flows))

    @cached_property
    def movement_dates(self) -> DataFrame:
        return self._dates.select(*CAMPAIGN, "Date")

    @cached_property
    def _spans(self) -> DataFrame:
        return grid.campaign_spans(self._dates)

    @cached_property
    def _days(self) -> DataFrame:
        return grid.calendar(self._dates, "_pos")

    @cached_property
    def ref_date_grid(self) -> DataFrame:
        return grid.ref_date_grid(self.ref_universe, self.movement_dates)

    @cached_property
    def _opened(self) -> DataFrame:
        return grid.opened(self.ref_universe, self._flows, self._dates)

    @cached_property
    def _timeline(self) -> DataFrame:
        return grid.running(self._opened, "_pos")

    @cached_property
    def movements_on_grid(self) -> DataFrame:
        return grid.movements_on_grid(self._timeline, self._spans, self._days)

    @cached_property
    def _cumulative(self) -> DataFrame:
        return grid.cumulative(self._timeline, self._spans, self._days, self.facts, "_pos", "_dates", "Date")

    @cached_property
    def cumulative_by_date(self) -> DataFrame:
        return grid.without_totals(self._cumulative)

    @cached_property
    def pct_cum_by_date(self) -> DataFrame:
        return grid.as_shares(self._cumulative)

    # ---- re-bucketing ----------------------------------------------------
    @cached_property
    def _released(self) -> DataFrame:
        """Spans of the campaigns with releases on references; only these are re-bucketed."""
        return self._spans.join(self.produced.where("has_release_ref").select(*CAMPAIGN), CAMPAIGN, "left_semi")

    @cached_property
    def next_release_date(self) -> DataFrame:
        return rebucket.next_release_date(self._opened, self._released, self._days)

    @cached_property
    def _by_release(self) -> DataFrame:
        timeline = rebucket.booked_timeline(self._opened, self._released)
        return grid.cumulative(timeline, self._released, grid.calendar(self._dates, "_bucket"), self.facts,
                               "_booked", "_buckets", "DateDeblocage")

    @cached_property
    def by_release_date(self) -> DataFrame:
        return grid.without_totals(self._by_release)

    @cached_property
    def pct_cum_by_release_date(self) -> DataFrame:
        return grid.as_shares(self._by_release)

    # ---- delay, lateness, details ----------------------------------------
    @cached_property
    def release_to_receipt_delay(self) -> DataFrame:
        releases = valuation.releases_valued(self.scoped(self.t.releases), self.purchase_price_by_ref, on_reference=True)
        return delivery.release_to_receipt_delay(releases, self.scoped(self._receipts_all), self.lookup)

    @cached_property
    def late_deliveries(self) -> DataFrame:
        return delivery.late_deliveries(self.purchase_lines, self.receipts_daily, self.lookup)

    @cached_property
    def receipts_with_catalogue(self) -> DataFrame:
        return details.with_catalogue(self.receipts_daily, self.purchase_lines, "IDCommandeAchat")

    @cached_property
    def shipments_with_catalogue(self) -> DataFrame:
        return details.with_catalogue(self.shipments, self._sales_rows, "IDCommandeVente")

    @cached_property
    def duplicate_release_alerts(self) -> DataFrame:
        return details.duplicate_release_alerts(self.releases_valued)
