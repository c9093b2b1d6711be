"""Merging what a fetch says of boards into their stored records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that a fetch fills in but never empties, and columns that it sets, to null too, where it says so in ``<column>_is_set``.
FILLED, STATED = ("company_name", "company_slug", "domain", "description", "logo_url", "scraped_logo_url"), ("scrape_status", "last_scrape_error", "last_http_status")


def upserted(stored: DataFrame, fetched: DataFrame, now: Column) -> DataFrame:
    """Boards after a fetch: one row for each (ats, board_token) of either table.

    fetched: the keys, FILLED and STATED columns with their ``_is_set`` flags, job_count and job_count_exact.  An exact count is
    taken as it is and decides whether the board is active; another only raises the stored one and never deactivates.
    """
    keys = ["ats", "board_token"]
    f = fetched.select(*keys, *[F.col(c).alias(f"_{c}") for c in fetched.columns if c not in keys]).withColumn("_hit", F.lit(True))
    j = stored.withColumn("_old", F.lit(True)).join(f, keys, "full_outer")
    hit, old = F.col("_hit").isNotNull(), F.col("_old").isNotNull()
    n = F.coalesce("_job_count", F.lit(0))
    exact = F.coalesce("_job_count_exact", F.lit(True)) | ~old
    value = {c: F.when(hit, F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in FILLED}
    value |= {c: F.when(hit & (F.coalesce(f"_{c}_is_set", F.lit(False)) | ~old), F.col(f"_{c}")).otherwise(F.col(c)) for c in STATED}
    value["last_scraped_at"] = F.when(hit, now).otherwise(F.col("last_scraped_at"))
    value["job_count"] = F.when(hit, F.when(exact, n).otherwise(F.greatest("job_count", n))).otherwise(F.col("job_count"))
    value["active"] = F.when(hit, F.when(exact, n > 0).otherwise(F.col("active") | (n > 0))).otherwise(F.col("active"))
    return j.select(*[value[c].alias(c) if c in value else F.col(c) for c in stored.columns])
