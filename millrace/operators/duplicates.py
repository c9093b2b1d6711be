"""Groups of duplicates within blocks: equal hashes, equal texts, or texts alike."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.components import components

#: Ratio from which texts are alike; texts of one block and of like length that one task compares with as many others, about.
ALIKE, ROOM = 0.95, 500


def exact_groups(rows: DataFrame, keys: list[Column], least: int = 2) -> DataFrame:
    """group_key and n of values that at least ``least`` rows share."""
    return rows.select(F.md5(F.to_json(F.struct(*keys))).alias("group_key")).groupBy("group_key").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def ratio(a: str, b: str) -> float:
    """2 * matching characters / all characters, by longest matching blocks."""
    return difflib.SequenceMatcher(None, a, b).ratio()


def alike_pairs(rows: DataFrame, block: list[str], least: float = ALIKE) -> DataFrame:
    """Pairs (a, b) of rows (no bigint, text string, block columns) of one block whose ratio is at least ``least``.

    A pair's lengths bound its ratio, so rows are dealt to windows of length that only such pairs share: a row
    goes to the window of its length and to the next.  A window of many rows is cut into parts, and every pair
    of parts is compared by itself, so no task holds more than two of them.
    """
    step = (2 - least) / least  # lengths of a pair that can reach the ratio differ by this factor at most
    level = F.floor(F.log(F.greatest(F.length("text"), F.lit(1))) / F.log(F.lit(step)))
    dealt = rows.withColumn("level", F.explode(F.array(level, level + 1))).withColumn("own", level)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        out = []
        items = list(zip(pdf["no"], pdf["text"], pdf["own"], pdf["level"], pdf["part"]))
        two = len(set(pdf["part"])) > 1
        for i, (a, x, la, level_, pa_) in enumerate(items):
            for b, y, lb, _, pb_ in items[i + 1 :]:
                if max(la, lb) != level_ or (two and pa_ == pb_):
                    continue  # met in the window of the longer one only, and pairs within a part by themselves
                if 2 * min(len(x), len(y)) >= least * (len(x) + len(y)):
                    m = difflib.SequenceMatcher(None, x, y)
                    if m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least:
                        out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"])

    several = F.count("*").over(Window.partitionBy(*block, "level"))
    parts = F.ceil(F.col("many") / ROOM)
    dealt = dealt.withColumn("many", several).filter("many > 1").withColumn("part", F.pmod("no", parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    dealt = dealt.withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other")).drop("many", "other")
    return dealt.groupBy(*block, "level", "x", "y").applyInPandas(compare, "a bigint, b bigint")


def duplicate_groups(rows: DataFrame, block: list[str], least: float = ALIKE) -> DataFrame:
    """(id, group_id) of rows with a duplicate in their block.

    rows: id, block columns, hash (null or '' joins nothing), text (null joins nothing).  Links are equal hashes,
    equal texts and texts alike; a group is what links connect, named after its block and its place
    among the block's groups by smallest id.
    """
    r = rows.select("id", *block, F.nullif("hash", F.lit("")).alias("hash"), "text").withColumn("no", F.xxhash64("id"))
    first = lambda by: F.min("no").over(Window.partitionBy(*block, by))
    linked = r.withColumn("h", F.when(F.col("hash").isNotNull(), first("hash"))).withColumn("t", F.when(F.col("text").isNotNull(), first("text")))
    exact = linked.select(F.col("no").alias("a"), F.col("h").alias("b")).filter("b is not null and a <> b").unionByName(linked.select(F.col("no").alias("a"), F.col("t").alias("b")).filter("b is not null and a <> b"))
    representatives = linked.filter("no = t").select("no", "text", *block)
    links = exact.unionByName(alike_pairs(representatives, block, least))
    grouped = r.select("id", "no", *block).join(components(links).withColumnRenamed("node", "no"), "no")
    least_id = grouped.withColumn("first", F.min("id").over(Window.partitionBy("root")))
    place = F.dense_rank().over(Window.partitionBy(*block).orderBy("first")) - 1
    name = F.concat_ws("__", *block, F.when(F.col("place") > 0, F.col("place").cast("string")))
    return least_id.withColumn("place", place).select("id", F.left(F.sha2(name, 256), F.lit(16)).alias("group_id"))


def changed_groups(old: DataFrame, new: DataFrame) -> DataFrame:
    """ids (of old and new: id, group_id) whose group or whose group's size differs."""
    size = lambda d, g, n: d.withColumn(n, F.count("*").over(Window.partitionBy("group_id"))).withColumnRenamed("group_id", g)
    j = size(old.filter("group_id is not null"), "g1", "n1").join(size(new.filter("group_id is not null"), "g2", "n2"), "id", "full_outer")
    return j.filter(~(F.col("g1").eqNullSafe(F.col("g2")) & F.col("n1").eqNullSafe(F.col("n2")))).select("id")


def repeated_line_hashes(rows: DataFrame, group: list[str], lines: Column, share: float = 0.4, least: int = 3) -> DataFrame:
    """Line hashes in more than ``share`` of a group's documents, of groups with at least ``least`` (id, group columns)."""
    sizes = rows.groupBy(*group).agg(F.countDistinct("id").alias("n")).filter(F.col("n") >= least)
    seen = rows.select(*group, "id", F.explode(F.array_distinct(lines)).alias("line_hash")).distinct()
    return seen.groupBy(*group, "line_hash").agg(F.count("*").alias("documents")).join(sizes, group).filter(F.col("documents") > F.col("n") * share).select(*group, "line_hash", "documents", "n")


