"""Payloads of the source systems as one table of postings: a projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.functions.text import first_of, record_id
from millrace.functions.values import moment

COLUMNS = ("id", "ats", "board_token", "title", "description", "location", "url", "apply_url", "department", "employment_type", "workplace_type", "locations", "posted_at", "updated_at")


def _get(path: str, raw: str = "raw") -> Column:
    return F.get_json_object(raw, f"$.{path}")


def _texts(path: str) -> Column:
    """A JSON array of texts."""
    return F.from_json(_get(path), "array<string>")


def _common(own: Column, **columns: Column) -> list[Column]:
    given = {"location": _get("location"), "url": _get("url"), "apply_url": first_of(_get("applyUrl"), _get("url")), "department": _get("department"), "employment_type": _get("employmentType"), "workplace_type": F.lower(_get("workplaceType")), "posted_at": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp"), "locations": F.array().cast("array<string>")} | columns
    return [record_id(F.col("ats"), F.col("board_token"), own), F.col("ats"), F.col("board_token"), *[F.coalesce(given[c], F.lit("")) if c not in ("posted_at", "updated_at", "locations") else given[c] for c in COLUMNS[3:]]]


def greenhouse() -> list[Column]:
    place = F.coalesce(_get("location.name"), _get("location"))
    departments = F.transform(F.from_json(_get("departments"), "array<struct<name:string>>"), lambda d: d["name"])
    offices = F.transform(F.from_json(_get("offices"), "array<struct<name:string>>"), lambda d: d["name"])
    return _common(_get("id"), title=_get("title"), description=first_of(_get("content"), _get("description")), location=place, url=_get("absolute_url"), apply_url=_get("absolute_url"), department=F.try_element_at(departments, F.lit(1)), locations=F.coalesce(offices, F.array().cast("array<string>")), posted_at=moment(_get("first_published")), updated_at=moment(_get("updated_at")))


def lever() -> list[Column]:
    lists = F.transform(F.from_json(_get("lists"), "array<struct<text:string,content:string>>"), lambda x: F.concat_ws("\n", x["text"], x["content"]))
    text = F.concat_ws("\n\n", first_of(_get("descriptionPlain"), _get("description")), F.array_join(F.coalesce(lists, F.array().cast("array<string>")), "\n\n"), first_of(_get("additionalPlain"), _get("additional")))
    return _common(_get("id"), title=first_of(_get("text"), _get("title")), description=text, location=_get("categories.location"), url=_get("hostedUrl"), department=_get("categories.department"), employment_type=_get("categories.commitment"), locations=F.coalesce(_texts("categories.allLocations"), F.array().cast("array<string>")), posted_at=moment(_get("createdAt")), updated_at=moment(_get("updatedAt")))


def ashby() -> list[Column]:
    more = F.transform(F.from_json(_get("secondaryLocations"), "array<struct<location:string>>"), lambda x: x["location"])
    return _common(_get("id"), title=_get("title"), description=first_of(_get("descriptionHtml"), _get("descriptionPlain")), url=_get("jobUrl"), locations=F.coalesce(more, F.array().cast("array<string>")), workplace_type=F.coalesce(F.lower(_get("workplaceType")), F.when(_get("isRemote") == "true", F.lit("remote"))), posted_at=moment(_get("publishedAt")))


def jobvite() -> list[Column]:
    return _common(_get("id"), title=_get("title"), description=first_of(_get("descriptionHtml"), _get("description")), posted_at=moment(_get("datePosted")))


def workable() -> list[Column]:
    places = F.from_json(_get("locations"), "array<struct<city:string,region:string,country:string,hidden:boolean>>")
    shown = F.transform(F.filter(places, lambda x: ~F.coalesce(x["hidden"], F.lit(False))), lambda x: F.array_join(F.filter(F.array(x["city"], x["region"], x["country"]), lambda p: p.isNotNull() & (p != "")), ", "))
    remote = F.when(_get("telecommuting") == "true", F.lit("remote"))
    return _common(_get("shortcode"), title=_get("title"), description=_get("description"), location=F.try_element_at(shown, F.lit(1)), locations=F.coalesce(shown, F.array().cast("array<string>")), apply_url=first_of(_get("application_url"), _get("url")), employment_type=_get("employment_type"), workplace_type=remote, posted_at=first_moment(_get("published_on"), _get("created_at")))


def first_moment(*cs: Column) -> Column:
    return F.coalesce(*[moment(c) for c in cs])


#: Values of COLUMNS by source system; a further system registers its own here.
NORMALIZE: dict[str, Callable[[], list[Column]]] = {"greenhouse": greenhouse, "lever": lever, "ashby": ashby, "jobvite": jobvite, "workable": workable}


def normalized(rows: DataFrame) -> DataFrame:
    """Postings of all systems (rows: ats, board_token, raw JSON text), in one pass; unknown systems yield none."""
    values = {name: f() for name, f in NORMALIZE.items()}

    def column(n: int) -> Column:
        out = F
        for name, own in values.items():
            out = out.when(F.col("ats") == name, own[n])
        return out

    return rows.filter(F.col("ats").isin(list(values))).select(*[column(n).alias(c) for n, c in enumerate(COLUMNS)])


def one_per_shortcode(rows: DataFrame, key: str = "shortcode", many: str = "locations", order: str = "position") -> DataFrame:
    """Entries of one key as one: each scalar from the first entry that has it, arrays joined in order without repeats."""
    rest = [c for c in rows.columns if c not in (key, many, order)]
    value = [F.try_element_at(F.transform(F.array_sort(F.filter(F.collect_list(F.struct(order, F.nullif(F.col(c).cast("string"), F.lit("")).alias("v"))), lambda x: x["v"].isNotNull())), lambda x: x["v"]), F.lit(1)).alias(c) for c in rest]
    arrays = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order, many))), lambda x: x[many]))).alias(many)
    return rows.groupBy(key).agg(*value, arrays)


def with_stored_details(listed: DataFrame, stored: DataFrame, key: str = "id", complete: tuple[str, ...] = ("description", "descriptionHtml", "datePosted")) -> tuple[DataFrame, DataFrame]:
    """(entries completed from stored details, entries whose detail must be fetched); inactive ones are dropped."""
    s = stored.filter("not coalesce(inactive, false)").select(key, *[F.nullif(F.col(c), F.lit("")).alias(f"_{c}") for c in complete])
    active = listed.join(stored.filter("inactive").select(key), key, "left_anti")
    j = active.join(s, key, "left")
    whole = reduce(lambda a, b: a & b, [F.col(f"_{c}").isNotNull() for c in complete])
    done = j.filter(whole).select(*[c for c in active.columns if c not in complete], *[F.col(f"_{c}").alias(c) for c in complete])
    return done, j.filter(~whole).select(*active.columns)


class BoardPartition(InputPartition):
    def __init__(self, ats: str, token: str) -> None:
        self.ats, self.token = ats, token


class BoardReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[BoardPartition]:
        pairs = [b.partition(":") for b in self.options.get("boards", "").split(",") if b.strip()]
        return [BoardPartition(a.strip(), t.strip()) for a, _, t in pairs]

    def read(self, partition: BoardPartition) -> Iterator[tuple]:
        import importlib
        import json
        import time

        module, _, name = self.options["fetcher"].partition(":")
        fetch = getattr(importlib.import_module(module), name)
        tries = int(self.options.get("tries", "3"))
        for attempt in range(tries):
            try:
                for payload in fetch(partition.ats, partition.token):
                    yield partition.ats, partition.token, payload if isinstance(payload, str) else json.dumps(payload)
                return
            except OSError:
                if attempt == tries - 1:
                    raise
                time.sleep(float(self.options.get("backoff", "0.5")) * 2**attempt)


class Boards(DataSource):
    """Postings of boards, one partition a board: spark.read.format("boards").option("boards", "lever:acme,...").option("fetcher", "module:function").

    The fetcher is any importable function (ats, token) -> payloads; the engine itself speaks no network protocol.
    """

    @classmethod
    def name(cls) -> str:
        return "boards"

    def schema(self) -> str:
        return "ats string, board_token string, raw string"

    def reader(self, schema) -> BoardReader:
        return BoardReader(dict(self.options))
