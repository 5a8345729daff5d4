"""Registry analytics on Spark: clean, enrich and publish monthly company registry snapshots."""

from firmroll.functions.dates import parse_date_any
from firmroll.operators.lookups import describe, measure_lookups
from firmroll.operators.numbering import number_ranged, number_rows, number_sorted
from firmroll.operators.partners import partner_rank, top_partners
from firmroll.operators.skew import hot_keys, left_join_all, salted_left_join
from firmroll.plans.enrich import Feeds, active_establishments, enrich, enriched_rows
from firmroll.plans.ingest import ingest_feed, stage_feed
from firmroll.plans.metrics import snapshot_metrics
from firmroll.plans.monthly import publish_month, stage_month
from firmroll.plans.publish import publish_snapshot, recover
from firmroll.sources.feeds import read_processed, read_raw, write_processed
from firmroll.sources.listing import latest_period, latest_period_in_pages
from firmroll.sources.storage import clear_scratch, read_snapshot, write_staging

__all__ = [
    "Feeds",
    "active_establishments",
    "clear_scratch",
    "describe",
    "enrich",
    "enriched_rows",
    "hot_keys",
    "ingest_feed",
    "latest_period",
    "latest_period_in_pages",
    "left_join_all",
    "measure_lookups",
    "number_ranged",
    "number_rows",
    "number_sorted",
    "parse_date_any",
    "partner_rank",
    "publish_month",
    "publish_snapshot",
    "read_processed",
    "read_raw",
    "read_snapshot",
    "recover",
    "salted_left_join",
    "snapshot_metrics",
    "stage_feed",
    "stage_month",
    "top_partners",
    "write_processed",
    "write_staging",
]
