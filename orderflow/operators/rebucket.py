"""Re-bucketing of every flow to the next release date of its reference.

A movement on day D of reference R is booked on the first release date of R at
or after D; when R has no later release it goes to the campaign's last
movement date.  Only campaigns with releases on references are re-bucketed.

The buckets of a campaign are its release dates plus its last movement date
(the row of any reference on the last date can only be booked there), so the
re-bucketed table is computed from the flows themselves, not from the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.exprs import CAMPAIGN, EXACT, fsum0
from orderflow.operators.byref import GRID_KEYS
from orderflow.operators.grid import MEASURES, expanded, running


def next_release_date(rows: DataFrame, spans: DataFrame, days: DataFrame) -> DataFrame:
    """Grid rows with the release date they are booked on (``DateDeblocage``).

    ``rows`` are the opened flows.  Walking the dates backwards, the running
    minimum of release dates gives a row's next release, its own day included
    or not; the days between two rows of a reference see the later one's."""
    back = Window.partitionBy(*GRID_KEYS).orderBy(F.col("_pos").desc_nulls_last())
    upto = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = back.rowsBetween(Window.unboundedPreceding, -1)
    marked = rows.select(*GRID_KEYS, "_pos", F.lag("_pos").over(back).alias("_until"),
                         F.min("DateDeblocage").over(upto).alias("_at"), F.min("DateDeblocage").over(before).alias("_later"))
    booked = F.coalesce(F.when(F.col("_moves"), F.col("_at")).otherwise(F.col("_later")), F.col("_last_date"))
    return (expanded(marked.join(spans, CAMPAIGN), days, "_pos", "_dates")
            .select(*GRID_KEYS, F.col("_day").alias("Date"), booked.alias("DateDeblocage")))


def booked_timeline(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Opened flows summed by (reference, bucket), with running totals; the
    opening row has no bucket.  A campaign's last bucket is its last date.  One
    shuffle on (campaign, reference) serves the backward window, the group-by
    and the running window."""
    back = (Window.partitionBy(*GRID_KEYS).orderBy(F.col("_pos").desc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # A row's own bucket counts only where the reference itself has a release that day.
    own = F.when(F.col("DateDeblocage").isNotNull(), F.col("_bucket"))
    bucket = F.when(F.col("_pos").isNotNull(), F.coalesce(F.min(own).over(back), F.col("_buckets")))
    sums = (rows.join(spans, CAMPAIGN).select(*GRID_KEYS, bucket.alias("_booked"), *MEASURES)
            .groupBy(*GRID_KEYS, "_booked")
            .agg(*[fsum0(c).cast(EXACT).alias(c) for c in MEASURES]))
    return running(sums, "_booked")
