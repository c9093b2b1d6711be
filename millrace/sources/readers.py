"""Reading the engine's input formats as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import trimmed


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of text files, in the order of files and lines."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    return lines.select(F.row_number().over(Window.orderBy("at")).alias("line_no"), "line")  # lists of boards: short files


def companies(spark: SparkSession, path: str, default: str = "greenhouse") -> DataFrame:
    """(line_no, ats, board_token) of a list with one ``ats:token`` or ``token`` a line; blank lines and # comments skipped."""
    own = numbered_lines(spark, path).select("line_no", trimmed("line").alias("line")).filter("line <> '' and not startswith(line, '#')")
    parts = F.split("line", ":", 2)
    named = F.size(parts) > 1
    return own.select("line_no", F.when(named, trimmed(parts[0])).otherwise(F.lit(default)).alias("ats"), F.when(named, trimmed(F.try_element_at(parts, F.lit(2)))).otherwise(F.col("line")).alias("board_token"))


def tokens(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, token) of a list, each token where it first stands; blank lines and # comments skipped."""
    own = numbered_lines(spark, path).select("line_no", trimmed("line").alias("token")).filter("token <> '' and not startswith(token, '#')")
    return own.groupBy("token").agg(F.min("line_no").alias("line_no")).select("line_no", "token")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Line-delimited JSON, plain or compressed (bz2 splits); lines that can't be read come back as nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def fields(spark: SparkSession, path: str) -> DataFrame:
    """(f array<string>) of tab-separated dumps without header; comment and blank lines skipped."""
    return spark.read.text(path).filter("value <> '' and not startswith(value, '#')").select(F.split("value", "\t", -1).alias("f"))


def rates(xml: Column) -> Column:
    """array<struct<code, units>> of a rates feed: elements Cube with currency and rate inside the first dated one."""
    at = "(//*[local-name()='Cube'][@time])[1]"
    codes, units = F.xpath(xml, F.lit(f"{at}/*[local-name()='Cube']/@currency")), F.xpath(xml, F.lit(f"{at}/*[local-name()='Cube']/@rate"))
    return F.transform(F.arrays_zip(codes.alias("code"), units.alias("units")), lambda x: F.struct(F.upper(x["code"]).alias("code"), x["units"].try_cast("double").alias("units")))


def rates_date(xml: Column) -> Column:
    return F.xpath_string(xml, F.lit("(//*[local-name()='Cube'][@time])[1]/@time")).try_cast("date")


def usd_rates(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """(currency_code, as_of_date, usd_per_unit) of rate feeds quoted per euro; a feed without dollars yields nothing."""
    r = feeds.select(rates_date(F.col(xml)).alias("as_of_date"), rates(F.col(xml)).alias("r"))
    usd = F.try_element_at(F.filter("r", lambda x: x["code"] == "USD"), F.lit(1))["units"]
    listed = r.withColumn("usd", usd).filter("usd > 0 and as_of_date is not null")
    rows = listed.select("as_of_date", "usd", F.explode(F.concat("r", F.array(F.struct(F.lit("EUR").alias("code"), F.lit(1.0).alias("units"))))).alias("x"))
    return rows.filter("x.units > 0").select(F.col("x.code").alias("currency_code"), "as_of_date", F.when(F.col("x.code") == "USD", 1.0).otherwise(F.col("usd") / F.col("x.units")).alias("usd_per_unit"))


def batch_results(lines: DataFrame, value: str = "value") -> DataFrame:
    """(job_id, ok, payload, error) of batch output lines, whichever of the known shapes they have."""
    g = lambda p: F.get_json_object(value, f"$.{p}")
    payload = F.coalesce(g("response"), g("output.response"), F.when(g("candidates").isNotNull(), F.col(value)), F.when(g("output.candidates").isNotNull(), g("output")))
    error = F.coalesce(g("error.message"), g("error"), g("output.error.message"), g("output.error"))
    job = F.coalesce(g("metadata.job_id"), g("request.metadata.job_id"), g("output.metadata.job_id"), g("key"))
    own = lines.filter(F.trim(value) != "")
    return own.select(job.alias("job_id"), (payload.isNotNull() & error.isNull()).alias("ok"), payload.alias("payload"), error.alias("error"))


def matched_results(results: DataFrame, leases: DataFrame) -> DataFrame:
    """Batch results against leases by job id, never by order: (job_id, status) with matched, failed, missing, unknown or repeated."""
    r = results.groupBy("job_id").agg(F.count("*").alias("n"), F.max("ok").alias("ok"))
    j = leases.select("job_id", F.lit(True).alias("leased")).join(r, "job_id", "full_outer")
    status = F.when(F.col("leased").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").when(F.col("ok"), "matched").otherwise("failed")
    return j.select("job_id", status.alias("status"))


#: The header's word and the page's title of an answer that asks whether a reader is a robot.
MITIGATED, ASKING_TITLE = "challenge", "Security challenge"


def page_title(body: Column) -> Column:
    """The text of a page's title element, spaces collapsed; null without one."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_extract(body, r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " ")), F.lit(""))


def probe_class(status: Column, mitigated: Column, body: Column) -> Column:
    """What an endpoint's answer is: ok, unexpected_json_200, non_json_200, challenge, error or request_error (no answer).

    A good answer is judged by its JSON alone, whatever words it holds; any other is a challenge by its header or title.
    """
    parsed = F.try_parse_json(body)
    kind = F.schema_of_variant(parsed)
    jobs = kind.startswith("OBJECT") & F.array_contains(F.json_object_keys(body), "jobs")
    asked = (mitigated == MITIGATED) | (page_title(body) == ASKING_TITLE)
    return (
        F.when(status.isNull(), "request_error")
        .when((status == 200) & parsed.isNull(), "non_json_200")
        .when((status == 200) & jobs, "ok")
        .when(status == 200, "unexpected_json_200")
        .when(asked, "challenge")
        .otherwise("error")
    )
