"""Queries of this subpackage over the project's tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import canonical, lines, mixing, nearduplicates, packing, spans, sql, tokens
from millrace.operators.components import components
from millrace.scratch import cut
from millrace.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of jobs that repeat in more than 40 % of their board's jobs."""
    return lines.repeated_lines(lines.posting_lines(table(spark, folder, "pipeline_jobs"))).distinct()


def p1_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Every job's body without the repeated lines, and how many were taken out."""
    return lines.cleaned(lines.posting_lines(table(spark, folder, "pipeline_jobs"), whole=True))


def p1_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of consecutive lines in more than 40 % of their board's jobs, by length."""
    found = lines.counted_blocks(cut(lines.posting_lines(table(spark, folder, "pipeline_jobs")), "lines"))
    return found.select(F.get_json_object("source", "$.ats").alias("ats"), F.get_json_object("source", "$.board_token").alias("board_token"), F.size("block").alias("n_lines"), F.hex(F.xxhash64("block")).alias("block_id"))


def _similar_jobs(spark: SparkSession, folder: str) -> nearduplicates.Similar:
    jobs = table(spark, folder, "pipeline_jobs").select("id", F.col("raw_json").alias("raw"))
    return nearduplicates.Similar(jobs, n=3, threshold=0.6, text_of=nearduplicates.posting_text)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of jobs whose bodies share at least 0.6 of their word triples."""
    return _similar_jobs(spark, folder).pairs()


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    """For every job with a body of three words or more: the group of similar jobs it is in, and its number of links to other texts."""
    similar = _similar_jobs(spark, folder)
    both = similar.links.select("a", "b").unionByName(similar.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.groupBy("a").agg(F.count("*").alias("n"))
    group = components(similar.links)
    out = similar.classes.join(group.withColumnRenamed("node", "rep"), "rep", "left").join(degree.withColumnRenamed("a", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    names = out.groupBy("root").agg(F.min("id").alias("group_id"), F.count("*").alias("group_size"))
    return out.join(names, "root").select("id", "group_id", "group_size", F.coalesce("n", F.lit(0)).alias("links"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The place that each unresolved location row means, 0 for none."""
    typed = table(spark, folder, "job_locations").filter("geoname_id is null").select(F.col("location_id").alias("id"), "label", "city", "state", "country_code")
    return canonical.mapped(typed, table(spark, folder, "geo_places")).select(F.col("id").alias("location_id"), "geoname_id")


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("doc"), "source", "text")
    return cut(tokens.token_counts(documents, ["doc", "source"]), "sizes")


def _containers(spark: SparkSession, folder: str, sizes: DataFrame) -> DataFrame:
    limits = table(spark, folder, "pack_limits").filter("limit_name is not null and capacity_tokens > 0").select("limit_name", "capacity_tokens").distinct().orderBy("limit_name").collect()  # one row for each kind of container; each has a plan of its own
    parts = [packing.packed(sizes, int(r["capacity_tokens"])).select(F.lit(r["limit_name"]).alias("limit_name"), F.col("doc").alias("doc_id"), "piece", "first_token", "tokens", "container") for r in limits]
    if not parts:
        return packing.packed(sizes, 1).limit(0).select(F.lit("").alias("limit_name"), F.col("doc").alias("doc_id"), "piece", "first_token", "tokens", "container")
    return reduce(DataFrame.unionByName, parts)


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of every capacity in pack_limits for all texts."""
    return _containers(spark, folder, _sizes(spark, folder).select("doc", "tokens"))


def p7_filling(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers of each capacity are, beside the least number that could hold the tokens."""
    capacity = table(spark, folder, "pack_limits").select("limit_name", F.col("capacity_tokens").cast("bigint").alias("capacity")).distinct()
    rows = p7_containers(spark, folder).groupBy("limit_name").agg((F.max("container") + 1).alias("containers"), F.sum("tokens").alias("tokens"))
    return rows.join(capacity, "limit_name").select("limit_name", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"), (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("filled"))


def p7_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What every packing must keep: all texts and tokens, no container over its capacity, no text split that fits, no two containers that would go into one."""
    sizes = _sizes(spark, folder).select("doc", "tokens")
    rows = cut(_containers(spark, folder, sizes), "containers")
    capacity = table(spark, folder, "pack_limits").select("limit_name", F.col("capacity_tokens").cast("bigint").alias("capacity")).distinct()
    whole = sizes.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("whole"))
    texts = rows.groupBy("limit_name", "doc_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces")).join(capacity, "limit_name")
    texts = texts.groupBy("limit_name").agg(F.count("*").alias("documents"), F.sum("tokens").alias("packed"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("needless_splits"))
    loads = rows.filter("container is not null").groupBy("limit_name", "container").agg(F.sum("tokens").alias("load")).join(capacity, "limit_name")
    least = F.min("load").alias("least")
    loads = loads.groupBy("limit_name").agg(F.count_if(F.col("load") > F.col("capacity")).alias("overfull"), least, F.count("*").alias("n"), F.count_if(2 * F.col("load") <= F.col("capacity")).alias("small"))
    out = texts.join(loads, "limit_name").join(whole.withColumn("_k", F.lit(1)), F.col("_k") == 1)  # one row
    # at most one container is half empty: two such would have gone into one
    return out.select("limit_name", "documents", (F.col("whole") - F.col("packed")).alias("lost_tokens"), "overfull", "needless_splits", F.greatest(F.col("small") - 1, F.lit(0)).alias("unnecessary"))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Texts selected so that sources have their target shares, in the order of the schedule."""
    return mixing.Mix(_sizes(spark, folder), table(spark, folder, "mix_targets")).chosen.select("slot", "source", F.col("doc").alias("doc_id"), "repeat", "tokens")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares that the mix was to have, could have and has."""
    return mixing.Mix(_sizes(spark, folder), table(spark, folder, "mix_targets")).shares()


def p8_kept(spark: SparkSession, folder: str) -> DataFrame:
    """What every mix must keep: repeats within their caps, texts under their own sources, shares as near as a slot allows."""
    sizes = _sizes(spark, folder)
    mix = mixing.Mix(sizes, table(spark, folder, "mix_targets"))
    chosen = cut(mix.chosen, "chosen")
    shares = mix.shares(chosen)
    used = chosen.groupBy("source", "doc").agg(F.count("*").alias("times")).join(sizes.select("doc", F.col("source").alias("own")), "doc", "left").join(shares.select("source", "max_repeats"), "source")
    wrong = used.groupBy("source").agg(F.count_if(F.col("times") > F.col("max_repeats")).alias("overused"), F.count_if(~F.col("own").eqNullSafe(F.col("source"))).alias("foreign_texts"))
    return shares.join(wrong, "source", "left").select("source", F.coalesce("overused", F.lit(0)).alias("overused"), F.coalesce("foreign_texts", F.lit(0)).alias("foreign_texts"), (F.abs(F.col("share_reached") - F.col("share_possible")) <= 0.01).alias("on_target"))


#: Batches in which the documents come to the index, as shares of them: most at first, then small ones.
BATCHES = (6, 1, 1)


def _spans(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("doc"), "text")
    arrival = F.pmod(F.xxhash64("doc"), F.lit(sum(BATCHES)))
    index = spans.SpanIndex(spark)
    found: list[DataFrame] = []
    for number in range(len(BATCHES)):
        before, so_far = sum(BATCHES[:number]), sum(BATCHES[: number + 1])
        index.tidy()  # for the batch to come; after the last one it would serve none
        index.add(documents.filter((arrival >= before) & (arrival < so_far)))
        found.append(index.found(documents.filter(arrival < so_far), since=number))
    return documents, index.located(reduce(DataFrame.unionByName, found).distinct())


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of texts that stand, at least 200 characters long, in other texts too."""
    return _spans(spark, folder)[1].withColumnRenamed("doc", "doc_id")


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """For every text its stretches found elsewhere and the share of the text they make up."""
    documents, found = _spans(spark, folder)
    return spans.shared_share(documents, cut(found, "spans")).withColumnRenamed("doc", "doc_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_bodies, p1_blocks, p3_found, p3_groups, p5_found, p7_containers, p7_filling, p7_kept, p8_mix, p8_shares, p8_kept, p9_found, p9_shares)}

SQL: dict[str, str] = {"p1_found": sql.P1_FOUND, "p1_bodies": sql.P1_BODIES, "p3_found": sql.P3_FOUND, "p3_groups": sql.P3_GROUPS, "p7_kept": sql.P7_KEPT, "p8_kept": sql.P8_KEPT, "p9_found": sql.P9_FOUND, "p9_shares": sql.P9_SHARES}
