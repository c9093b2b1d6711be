"""Unique slugs for companies, assigned as joins and windows over distinct identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import base_slug, domain_root, identity_key, nz, short_id, slug

#: Key of the suffixes' digests.
PERSON = "company"


def slug_map(companies: DataFrame, person: str = PERSON) -> DataFrame:
    """(ats, board_token, slug): boards of one company share a slug, different companies never do.

    Of the companies that wish for a slug the first by identity gets it.  Another gets the slug with its domain's
    root, if it is the first to ask for that and nobody wishes for that as its own; else the slug with a
    digest of its identity (eight characters, so only equal digests could clash; those get the longer digest).
    Rows without ats or board_token are left out.
    """
    c = companies.filter("ats is not null and board_token is not null").select("ats", "board_token", "company_name", "domain").distinct()
    name, domain, board, ats = (F.col(x) for x in ("company_name", "domain", "board_token", "ats"))
    rows = c.select("ats", "board_token", identity_key(name, domain, ats, board).alias("identity"), base_slug(name, domain, board).alias("base"), slug(domain_root(domain)).alias("root"))
    own = rows.groupBy("identity").agg(F.min(F.struct("ats", "board_token", "base", "root")).alias("first")).select("identity", "first.base", "first.root")
    ranked = own.withColumn("place", F.row_number().over(Window.partitionBy("base").orderBy("identity")))
    wished = ranked.select(F.col("base").alias("taken")).distinct()
    second = F.when((F.col("place") > 1) & nz("root").isNotNull() & (F.col("root") != F.col("base")), F.concat_ws("-", "base", "root"))
    asked = ranked.withColumn("second", second).join(wished, F.col("second") == F.col("taken"), "left")
    turn = F.row_number().over(Window.partitionBy("second").orderBy("identity"))
    asked = asked.withColumn("gets", F.col("second").isNotNull() & F.col("taken").isNull() & (turn == 1))
    tail = short_id(person, 5)(F.col("identity"))
    first_try = F.when(F.col("place") == 1, F.col("base")).when(F.col("gets"), F.col("second")).otherwise(F.concat_ws("-", "base", tail))
    tried = asked.select("identity", "base", first_try.alias("slug"))
    clash = F.row_number().over(Window.partitionBy("slug").orderBy(F.col("slug") != F.col("base"), "identity"))
    final = tried.withColumn("n", clash).select("identity", F.when(F.col("n") == 1, F.col("slug")).otherwise(F.concat_ws("-", "base", short_id(person, 20)(F.col("identity")))).alias("slug"))
    return rows.select("ats", "board_token", "identity").dropDuplicates(["ats", "board_token"]).join(final, "identity").select("ats", "board_token", "slug")
