"""Values read out of text by patterns, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags that say where work is done, in order.
TAGS = (("#LI-REMOTE", "remote"), ("#LI-HYBRID", "hybrid"), ("#LI-ONSITE", "onsite"))


def workplace_tag(text: Column) -> Column:
    """remote, hybrid or onsite by a tag in the text; the first that stands in it, in that order."""
    up = F.upper(text)
    out = F.lit(None).cast("string")
    for tag, value in reversed(TAGS):
        out = F.when(F.contains(up, F.lit(tag)), F.lit(value)).otherwise(out)
    return out


def summary_range(text: Column) -> Column:
    """struct<low, high> of the dollar amounts, with k or m, in a short summary; null without one."""
    parts = F.regexp_extract_all(text, F.lit(r"\$([\d,.]+[KkMm]?)"), 1)

    def value(p: Column) -> Column:
        scale = F.when(F.regexp(p, F.lit("[Kk]$")), 1e3).when(F.regexp(p, F.lit("[Mm]$")), 1e6).otherwise(1.0)
        return F.regexp_replace(p, "[,KkMm]", "").try_cast("double") * scale

    values = F.filter(F.transform(parts, value), lambda x: x.isNotNull())
    return F.when(F.size(values) > 0, F.struct(F.try_element_at(values, F.lit(1)).alias("low"), F.try_element_at(values, F.least(F.size(values), F.lit(2))).alias("high")))
