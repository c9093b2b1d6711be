"""Queries about stored state, its order and its documents, and about places, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import nested, nested_places
from millrace.functions import text as tx
from millrace.functions import values as vl
from millrace.operators import companies, gazetteer, merge, near, regions, selection
from millrace.plans.catalogue import _FOLD, _HOST, _JOBS, _STATE, QUERIES, SQL, _jobs, _state, query
from millrace.sources import readers, sinks
from millrace.tables import table

__all__ = ["QUERIES", "SQL"]

_VERSION = "md5(concat_ws('|', 'v1', coalesce({h}, ''), coalesce(strftime(j.last_parsed_at, '%Y-%m-%d %H:%M:%S.%f'), ''), coalesce(j.job_group, j.id)))"
_INDEXED = f"(SELECT id, content_hash FROM {_STATE} WHERE snapshot_no = (SELECT max(snapshot_no) FROM job_snapshots))"


@query(f"""
SELECT j.id FROM {_JOBS} j LEFT JOIN {_INDEXED} d ON d.id = j.id
WHERE j.removed_at IS NULL AND j.raw_json IS NOT NULL AND CASE WHEN d.id IS NOT NULL THEN {_VERSION.format(h='d.content_hash')} END IS DISTINCT FROM {_VERSION.format(h='j.content_hash')}""")
def pending_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Live jobs whose stored document version (here of the last delivery's content) is missing or another than it should be."""
    jobs = _jobs(spark, folder)
    version = lambda h: tx.document_version("v1", h, F.col("last_parsed_at"), F.col("job_group"), F.col("id"))
    last = table(spark, folder, "job_snapshots").agg(F.max("snapshot_no").alias("snapshot_no"))
    held = _state(spark, folder).join(F.broadcast(last), "snapshot_no").select("id", F.col("content_hash").alias("held_hash"))  # one row
    live = jobs.filter("removed_at is null and raw_json is not null").select("id", version(F.col("content_hash")).alias("version"))
    current = jobs.join(held, "id").select("id", version(F.col("held_hash")).alias("version"))
    return sinks.index_changes(current, live)[0].select("id")


@query(f"SELECT id FROM {_JOBS} WHERE parsed_json IS NULL AND meili_loaded_at < TIMESTAMP '2025-04-01'")
def loaded_unparsed(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs that were loaded before a date without having been parsed."""
    return _jobs(spark, folder).filter(F.col("parsed_json").isNull() & (F.col("meili_loaded_at") < F.lit("2025-04-01").cast("timestamp_ntz"))).select("id")


@query(f"""
SELECT id FROM {_JOBS} WHERE removed_at IS NULL AND parsed_json IS NOT NULL AND meili_loaded_at IS NOT NULL
AND (parse_provider IS DISTINCT FROM 'v2' OR CASE WHEN meili_loaded_at >= last_parsed_at THEN last_parsed_at END IS DISTINCT FROM last_parsed_at)""")
def stale_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """Live parsed and loaded jobs whose recommendations are missing, of another algorithm or made from an earlier parse."""
    jobs = _jobs(spark, folder).filter("removed_at is null and parsed_json is not null and meili_loaded_at is not null")
    made = jobs.select("id", F.col("parse_provider").alias("algorithm"), F.when(F.col("meili_loaded_at") >= F.col("last_parsed_at"), F.col("last_parsed_at")).alias("source_parsed_at"))
    return selection.outdated(jobs.select("id", "last_parsed_at"), made, "v2").select("id")


@query(f"SELECT (SELECT count(*) FROM pipeline_companies) AS boards, count(*) AS jobs, count(*) FILTER (WHERE removed_at IS NULL) AS live, count(*) FILTER (WHERE needs_parse) AS waiting, sum(parse_error_count) AS failures FROM {_JOBS}")
def table_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over the whole tables, in one row."""
    jobs = _jobs(spark, folder).agg(F.count("*").alias("jobs"), F.count_if(F.col("removed_at").isNull()).alias("live"), F.count_if("needs_parse").alias("waiting"), F.sum("parse_error_count").alias("failures"))
    boards = table(spark, folder, "pipeline_companies").agg(F.count("*").alias("boards"))
    return jobs.withColumn("k", F.lit(0)).join(boards.withColumn("k", F.lit(0)), "k").drop("k")


#: Orders in which stored rows are worked off: name, table, order as SQL, key. A top-k report of each.
_ORDERS = (
    ("parsed longest ago", "jobs", "last_parsed_at ASC NULLS LAST, id"),
    ("parsed last", "jobs", "last_parsed_at DESC NULLS LAST, id"),
    ("seen last", "jobs", "last_seen_at DESC NULLS LAST, id"),
    ("by board and title", "jobs", "board_token ASC NULLS LAST, title ASC NULLS LAST, id"),
    ("pending boards first", "boards", "CASE WHEN scrape_status = 'pending' OR scrape_status IS NULL THEN 0 ELSE 1 END, last_scraped_at ASC NULLS FIRST, id"),
    ("rates by code", "rates", "id"),
)
_SOURCES = {"jobs": f"(SELECT * FROM {_JOBS})", "boards": "(SELECT DISTINCT scrape_status, last_scraped_at, concat_ws(':', ats, board_token) AS id FROM pipeline_companies)", "rates": "(SELECT DISTINCT concat_ws(' ', currency_code, CAST(as_of_date AS VARCHAR)) AS id FROM fx_rates)"}


@query(" UNION ALL ".join(f"SELECT '{name}' AS list, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place, id FROM {_SOURCES[of]} QUALIFY place <= 30" for name, of, order in _ORDERS))
def work_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The first thirty of each order of work, with their places."""
    rows = {
        "jobs": _jobs(spark, folder),
        "boards": table(spark, folder, "pipeline_companies").select("scrape_status", "last_scraped_at", F.concat_ws(":", "ats", "board_token").alias("id")).distinct(),
        "rates": table(spark, folder, "fx_rates").select(F.concat_ws(" ", "currency_code", F.col("as_of_date").cast("string")).alias("id")).distinct(),
    }
    orders: dict[str, list[Column]] = {
        "parsed longest ago": [F.asc_nulls_last("last_parsed_at"), F.col("id")], "parsed last": [F.desc_nulls_last("last_parsed_at"), F.col("id")], "seen last": [F.desc_nulls_last("last_seen_at"), F.col("id")],
        "by board and title": [F.asc_nulls_last("board_token"), F.asc_nulls_last("title"), F.col("id")],
        "pending boards first": [F.when(F.coalesce("scrape_status", F.lit("pending")) == "pending", 0).otherwise(1), F.asc_nulls_first("last_scraped_at"), F.col("id")], "rates by code": [F.col("id")],
    }
    out = None
    for name, of, _ in _ORDERS:
        first = rows[of].orderBy(*orders[name]).limit(30)  # a top-k before any window
        part = first.select(F.lit(name).alias("list"), F.row_number().over(Window.orderBy(*orders[name])).alias("place"), "id")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"SELECT id, sha1(id) AS hash_id, ats || '__' || board_token || '__' || split_part(id, '__', -1) AS record_id, true AS seen_in_last_fetch FROM {_JOBS} WHERE ats IS NOT NULL AND board_token IS NOT NULL")
def default_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The fields that every fetched posting gets."""
    j = _jobs(spark, folder).filter("ats is not null and board_token is not null")
    own = F.element_at(F.split("id", "__"), -1)
    return j.select("id", F.sha1("id").alias("hash_id"), tx.record_id(F.col("ats"), F.col("board_token"), own).alias("record_id"), F.lit(True).alias("seen_in_last_fetch"))


@query(f"""
SELECT ats, board_token, array_to_string(list_transform(string_split(translate(board_token, '-_', '  '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS name,
    regexp_replace(logo_url, '[?#].*', '') AS logo, 'https://icons.example/' || coalesce(nullif({_HOST}, ''), company_slug || '.com') AS icon
FROM pipeline_companies""")
def board_faces(spark: SparkSession, folder: str) -> DataFrame:
    """What a board is shown with where its record says nothing better."""
    c = table(spark, folder, "pipeline_companies")
    return c.select("ats", "board_token", tx.titled("board_token").alias("name"), tx.without_query("logo_url").alias("logo"), tx.icon_link(F.col("domain"), F.col("company_slug")).alias("icon"))


@query("SELECT doc_id, left(regexp_replace(regexp_replace(regexp_replace(text, '\\b[A-Z]{2,}\\d+[A-Z0-9]*\\b', ' ', 'g'), '[\\s\\p{Z}\\x{85}\\x{0B}]+', ' ', 'g'), '^ | $', '', 'g'), 5000) AS t FROM documents WHERE text IS NOT NULL")
def language_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as a language detector takes them."""
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", tx.language_text("text").alias("t"))


_NESTED = """
l AS (SELECT DISTINCT ON (job_id, loc_pos, location_id) l.*, g.country_code AS pc, g.admin1_code AS pr FROM job_locations l LEFT JOIN geo_places g ON g.geoname_id = l.geoname_id WHERE job_id IS NOT NULL),
w AS (SELECT x.*, coalesce(nullif(label, ''), nullif(concat_ws(', ', nullif(city, ''), nullif(state, ''), nullif(country_code, '')), '')) AS shown,
    coalesce(a.code, CASE WHEN regexp_matches(trim(c), '^[A-Za-z]{2}$') THEN upper(trim(c)) END) AS code FROM (SELECT *, coalesce(nullif(pc, ''), country_code) AS c FROM l) x LEFT JOIN aliases a ON a.name = lower(trim(x.c)))"""
_ALIASES = "aliases(name, code) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in vl.COUNTRIES.items()) + ")"


@query(f"""
WITH {_ALIASES}, {_NESTED}
SELECT job_id, coalesce(list_sort(list_distinct(list(geoname_id))), []) AS work_geoname_ids, coalesce(list_sort(list_distinct(list(code))), []) AS work_country_codes,
    coalesce(list_sort(list_distinct(list(CASE WHEN code <> '' AND pr <> '' THEN code || '-' || pr END))), []) AS work_admin1_keys,
    coalesce(list_sort(list_distinct(list(code) FILTER (WHERE loc_pos > 0))), []) AS applicant_country_codes,
    coalesce(list_sort(list_distinct(list(CASE WHEN code <> '' AND pr <> '' THEN code || '-' || pr END) FILTER (WHERE loc_pos > 0 AND (city <> '' OR state <> '')))), []) AS applicant_admin1_keys
FROM w GROUP BY job_id""")
def job_place_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The five key arrays of every job with locations (all but the first stand in for applicant requirements, which the tables lack)."""
    out = _nested(spark, folder).select("job_id", *nested_places.geo_fields(F.col("locations"), F.col("requirements")))
    return out.select("job_id", *[F.sort_array(c).alias(c) for c in out.columns[1:]])


@query(f"""
WITH {_ALIASES}, {_NESTED}, s AS (SELECT job_id, shown, min((loc_pos, location_id)) AS spot FROM w WHERE shown IS NOT NULL GROUP BY ALL)
SELECT j.job_id, coalesce(labels, []) AS labels, coalesce(labels[1], '') AS display FROM (SELECT DISTINCT job_id FROM w) j LEFT JOIN (SELECT job_id, list(shown ORDER BY spot) AS labels FROM s GROUP BY job_id) x USING (job_id)""")
def job_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Location labels of every job with locations, and the one it shows."""
    n, office = _nested(spark, folder), F.lit("onsite")
    return n.select("job_id", nested_places.all_labels(F.col("locations"), F.col("requirements"), office).alias("labels"), nested_places.display_label(F.col("locations"), F.col("requirements"), office).alias("display"))


@query("""
WITH p AS (SELECT DISTINCT job_id, lat, lng FROM job_locations WHERE job_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lng) AND NOT isinf(lat) AND NOT isinf(lng))
SELECT j.job_id, count(p.lat) AS points, count(p.lat) > 0 AS has_shape FROM (SELECT DISTINCT job_id FROM job_locations WHERE job_id IS NOT NULL) j LEFT JOIN p USING (job_id) GROUP BY j.job_id""")
def job_points(spark: SparkSession, folder: str) -> DataFrame:
    """How many distinct usable points each job has, and whether they make a shape."""
    points = F.collect_list(F.struct("lat", "lng")).alias("points")
    j = table(spark, folder, "job_locations").filter("job_id is not null").groupBy("job_id").agg(points)
    return j.select("job_id", F.size(vl.usable_points(F.col("points"))).cast("bigint").alias("points"), vl.multi_point(F.col("points")).isNotNull().alias("has_shape"))


def _nested(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs with arrays of their locations (in order) and of stand-in requirements."""
    g = table(spark, folder, "geo_places").select("geoname_id", F.col("country_code").alias("place_country"), F.col("admin1_code").alias("place_region"))
    l = table(spark, folder, "job_locations").filter("job_id is not null").dropDuplicates(["job_id", "loc_pos", "location_id"]).join(g, "geoname_id", "left")  # noqa: E741
    entry = F.struct("loc_pos", "location_id", "label", "city", "state", "country_code", "geoname_id", "place_country", "place_region")
    j = l.groupBy("job_id").agg(F.array_sort(F.collect_list(entry)).alias("locations"))
    scope = lambda x: F.when(tx.nz(x["city"]).isNotNull(), "city").when(tx.nz(x["state"]).isNotNull(), "state").otherwise("country")
    wanted = F.transform(F.filter("locations", lambda x: x["loc_pos"] > 0), lambda x: F.struct(scope(x).alias("scope"), x["label"].alias("name"), x["state"].alias("region"), x["country_code"].alias("country_code"), x["geoname_id"].alias("geoname_id"), x["place_country"].alias("place_country"), x["place_region"].alias("place_region")))
    return j.withColumn("requirements", wanted)


_CANDIDATES = f"""
r AS (SELECT DISTINCT location_id AS key, nullif(trim(city), '') AS city, nullif(trim(state), '') AS state, CASE WHEN length(trim(country_code)) = 2 THEN upper(trim(country_code)) END AS cc FROM job_locations WHERE geoname_id IS NULL AND location_id IS NOT NULL),
c AS (
    SELECT key, 0 AS position, {_FOLD.format("city || ' ' || state || ' ' || cc")} AS name, 'locality' AS kind, cc FROM r WHERE city IS NOT NULL AND state IS NOT NULL AND cc IS NOT NULL
    UNION ALL SELECT key, 1, {_FOLD.format("city || ' ' || cc")}, 'locality', cc FROM r WHERE city IS NOT NULL AND cc IS NOT NULL
    UNION ALL SELECT key, 2, {_FOLD.format("city")}, 'locality', cc FROM r WHERE city IS NOT NULL
    UNION ALL SELECT key, 0, {_FOLD.format("state")}, 'admin1', cc FROM r WHERE city IS NULL AND state IS NOT NULL
    UNION ALL SELECT key, 0, {_FOLD.format("cc")}, 'country', NULL FROM r WHERE city IS NULL AND state IS NULL AND cc IS NOT NULL),
n AS (SELECT geoname_id, kind, country_code, population, display_name, unnest(list_distinct(search_names)) AS name FROM geo_places)"""


@query(f"""
WITH {_CANDIDATES}
SELECT key, geoname_id FROM (SELECT key, geoname_id, row_number() OVER (PARTITION BY key ORDER BY position, coalesce(population, -1) DESC, display_name, geoname_id) AS rn
    FROM c JOIN n ON n.name = c.name AND n.kind = c.kind AND (c.cc IS NULL OR n.country_code = c.cc) WHERE c.name <> '') WHERE rn = 1""")
def resolved_requirements(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each requirement by its scope (unresolved location rows stand in for requirements)."""
    rows = table(spark, folder, "job_locations").filter("geoname_id is null and location_id is not null").select("location_id", "city", "state", "country_code").distinct()
    city, state = tx.nz(F.trim("city")), tx.nz(F.trim("state"))
    scope = F.when(city.isNotNull(), "city").when(state.isNotNull(), "state").otherwise("country")
    r = rows.select(F.col("location_id").alias("key"), scope.alias("scope"), F.coalesce(city, state).alias("name"), F.when(city.isNotNull(), state).alias("region"), "country_code")
    return gazetteer.looked_up(gazetteer.requirement_candidates(r), table(spark, folder, "geo_places")).select("key", "geoname_id")


@query(f"""
SELECT j.id, list_filter([
    'Location: ' || coalesce(nullif(trim(j.raw_json ->> '$.location.name'), ''), CASE WHEN json_type(j.raw_json, '$.location') = 'VARCHAR' THEN nullif(trim(j.raw_json ->> '$.location'), '') END),
    'Workplace type: ' || nullif(trim(j.raw_json ->> '$.workplaceType'), ''), CASE WHEN j.raw_json ->> '$.isRemote' = 'true' THEN 'Remote flag: true' END,
    'Employment type: ' || coalesce(nullif(trim(j.raw_json ->> '$.employmentType'), ''), nullif(trim(j.raw_json ->> '$.commitment'), '')),
    'Department: ' || nullif(array_to_string(from_json(j.raw_json -> '$.departments', '["VARCHAR"]'), ', '), ''), 'Department: ' || nullif(trim(j.raw_json ->> '$.department'), ''),
    'Team: ' || nullif(trim(j.raw_json ->> '$.team'), '')], lambda x: x IS NOT NULL) AS lines
FROM {_JOBS} j WHERE j.raw_json IS NOT NULL AND json_valid(j.raw_json)""")
def posting_context(spark: SparkSession, folder: str) -> DataFrame:
    """What each payload says beside title and body."""
    return _jobs(spark, folder).filter("raw_json is not null").filter(F.try_parse_json("raw_json").isNotNull()).select("id", nested_places.context_lines(F.col("raw_json")).alias("lines"))


@query("""
WITH f AS (SELECT DISTINCT ON (ats, board_token) ats, board_token, company_name, job_count, last_http_status, active FROM pipeline_companies WHERE ats IS NOT NULL AND board_token IS NOT NULL AND last_http_status IS NOT NULL)
SELECT c.ats, c.board_token, c.company_name, CASE WHEN f.ats IS NULL THEN c.scrape_status WHEN f.last_http_status = 200 THEN 'ok' ELSE c.scrape_status END AS scrape_status,
    CASE WHEN f.last_http_status = 200 THEN NULL ELSE c.last_scrape_error END AS last_scrape_error, CASE WHEN f.ats IS NOT NULL THEN f.last_http_status + 1 ELSE c.last_http_status END AS last_http_status,
    CASE WHEN f.ats IS NULL THEN c.job_count WHEN f.last_http_status = 200 THEN 3 ELSE greatest(c.job_count, 3) END AS job_count, CASE WHEN f.ats IS NULL THEN c.active ELSE true END AS active
FROM pipeline_companies c LEFT JOIN f ON f.ats = c.ats AND f.board_token = c.board_token""")
def boards_after_fetch(spark: SparkSession, folder: str) -> DataFrame:
    """Boards after a fetch of those that answered: some columns left alone, some set, some set to nothing."""
    c = table(spark, folder, "pipeline_companies")
    ok = F.col("last_http_status") == 200
    keys = c.filter("ats is not null and board_token is not null and last_http_status is not null").dropDuplicates(["ats", "board_token"])
    none = F.lit(None).cast("string")
    fetched = keys.select(
        "ats", "board_token", *[none.alias(x) for x in companies.FILLED], F.when(ok, "ok").alias("scrape_status"), ok.alias("scrape_status_is_set"), none.alias("last_scrape_error"), ok.alias("last_scrape_error_is_set"),
        (F.col("last_http_status") + 1).alias("last_http_status"), F.lit(True).alias("last_http_status_is_set"), F.lit(3).alias("job_count"), ok.alias("job_count_exact"),
    )
    out = companies.upserted(c, fetched, F.lit("2025-04-01").cast("timestamp_ntz"))
    return out.select("ats", "board_token", "company_name", "scrape_status", "last_scrape_error", "last_http_status", "job_count", "active")


@query(f"""
WITH s AS (SELECT id, snapshot_no, content_hash FROM {_STATE} WHERE snapshot_no IS NOT NULL), n AS (SELECT DISTINCT snapshot_no FROM job_snapshots WHERE snapshot_no IS NOT NULL),
f AS (SELECT a.snapshot_no FROM n a JOIN n b ON b.snapshot_no = a.snapshot_no - 1),
t AS (SELECT id, snapshot_no + 1 AS snapshot_no, content_hash FROM s WHERE snapshot_no + 1 IN (SELECT snapshot_no FROM f)), u AS (SELECT * FROM s WHERE snapshot_no IN (SELECT snapshot_no FROM f))
SELECT coalesce(t.snapshot_no, u.snapshot_no) AS snapshot_no, CASE WHEN t.id IS NULL THEN 'new' WHEN u.id IS NULL THEN 'absent' WHEN t.content_hash IS NOT DISTINCT FROM u.content_hash THEN 'unchanged' ELSE 'changed' END AS change, count(*) AS n
FROM t FULL OUTER JOIN u ON t.id = u.id AND t.snapshot_no = u.snapshot_no GROUP BY 1, 2""")
def snapshot_change_counts(spark: SparkSession, folder: str) -> DataFrame:
    """New, changed, unchanged and absent records of every snapshot against the one before."""
    from millrace.plans.catalogue import change_counts

    return change_counts(spark, folder)


@query("""
WITH p AS (SELECT DISTINCT location_id, lat, lng FROM job_locations WHERE location_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lng) AND abs(lat) <= 90 AND abs(lng) <= 180 AND NOT (lat = 0 AND lng = 0))
SELECT DISTINCT q.location_id AS query_id, p.location_id FROM p q JOIN p ON p.lat BETWEEN q.lat - 0.1 AND q.lat + 0.1 AND p.location_id <> q.location_id
WHERE q.location_id % 20 = 0 AND 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(p.lat - q.lat) / 2), 2) + cos(radians(q.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lng - q.lng) / 2), 2)))) <= 5""")
def nearby_locations(spark: SparkSession, folder: str) -> DataFrame:
    """Locations at most 5 km from each location whose number is divisible by 20, among all."""
    p = table(spark, folder, "job_locations").select(F.col("location_id").alias("id"), "lat", "lng")
    return near.near(p, p.filter("id % 20 = 0"), 5.0).filter("point_id <> place_id").select(F.col("place_id").alias("query_id"), F.col("point_id").alias("location_id"))


@query("""
WITH b AS (SELECT min(geoname_id) AS region_id, min(latitude) AS a, max(latitude) AS c, min(longitude) AS d, max(longitude) AS e FROM geo_places WHERE kind = 'locality' AND latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude) AND country_code <> '' AND admin1_code <> '' GROUP BY country_code, admin1_code HAVING min(latitude) < max(latitude) AND min(longitude) < max(longitude)),
p AS (SELECT DISTINCT location_id, lat, lng FROM job_locations WHERE location_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lng) AND abs(lat) <= 90 AND abs(lng) <= 180 AND NOT (lat = 0 AND lng = 0))
SELECT DISTINCT location_id, region_id FROM p JOIN b ON abs(lat - (a + c) / 2) / ((c - a) / 2) + abs(lng - (d + e) / 2) / ((e - d) / 2) < 1""")
def located_regions(spark: SparkSession, folder: str) -> DataFrame:
    """The regions, here lozenges around the localities of each first-level division, that job locations lie in."""
    good = ~F.isnan("latitude") & ~F.isnan("longitude") & (F.col("country_code") != "") & (F.col("admin1_code") != "")
    b = table(spark, folder, "geo_places").filter("kind = 'locality' and latitude is not null and longitude is not null").filter(good).groupBy("country_code", "admin1_code").agg(F.min("geoname_id").alias("id"), F.min("latitude").alias("a"), F.max("latitude").alias("c"), F.min("longitude").alias("d"), F.max("longitude").alias("e")).filter("a < c and d < e")
    corner = lambda lat, lng: F.struct(F.expr(lat).alias("lat"), F.expr(lng).alias("lng"))
    ring = F.array(corner("a", "(d + e) / 2"), corner("(a + c) / 2", "e"), corner("c", "(d + e) / 2"), corner("(a + c) / 2", "d"))
    points = table(spark, folder, "job_locations").select(F.col("location_id").alias("id"), "lat", "lng")
    return regions.containing(points, b.select("id", ring.alias("ring"))).select(F.col("point_id").alias("location_id"), "region_id")


_ANSWER = "CASE coalesce(job_count, 0) % 4 WHEN 0 THEN '{\"jobs\": [{\"title\": \"captcha\"}]}' WHEN 1 THEN '{\"name\": 1}' WHEN 2 THEN '<html><title> Security  challenge</title>' ELSE 'oops' END"


@query(f"""
SELECT class, count(*) AS n FROM (SELECT CASE WHEN last_http_status IS NULL THEN 'request_error' WHEN last_http_status = 200 THEN CASE coalesce(job_count, 0) % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'unexpected_json_200' ELSE 'non_json_200' END
    WHEN NOT active OR coalesce(job_count, 0) % 4 = 2 THEN 'challenge' ELSE 'error' END AS class FROM pipeline_companies) GROUP BY class""")
def probe_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Boards by the class of an answer with a body of each kind (the bodies are made up, as none were kept)."""
    c = table(spark, folder, "pipeline_companies")
    return c.groupBy(readers.probe_class(F.col("last_http_status"), F.when(~F.col("active"), "challenge"), F.expr(_ANSWER)).alias("class")).agg(F.count("*").alias("n"))


@query(f"""
SELECT id, coalesce(j.title, '') AS title, content_hash, 'late' AS status FROM {_JOBS} j WHERE parse_error_count > 0
UNION ALL SELECT id, 'rewritten' AS title, content_hash, 'applied' AS status FROM {_JOBS} WHERE parse_error_count IS NULL OR parse_error_count = 0""")
def rewritten_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Jobs whose title is rewritten where nothing failed before; the others keep theirs."""
    j = _jobs(spark, folder).select("id", F.coalesce("title", F.lit("")).alias("title"), "content_hash", "parse_error_count").withColumn("status", F.lit("late"))
    named = j.filter("parse_error_count is null or parse_error_count = 0").select("id", F.lit("rewritten").alias("title"))
    out = merge.update_where(j, named, ["id"], {"title": lambda old, new: new, "status": lambda old, new: F.lit("applied")})
    return out.select("id", "title", "content_hash", "status")


@query("SELECT part.p_partkey, count(*) AS lines, list_sort(list_distinct(list(l_linestatus))) AS states FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def part_states(spark: SparkSession, folder: str) -> DataFrame:
    """The states of each part's lines, the first line of each state kept."""
    entry = F.struct("l_orderkey", "l_linenumber", "l_linestatus")
    g = table(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("lines"), F.array_sort(F.collect_list(entry)).alias("entries"))
    first = nested.first_by_key(F.col("entries"), lambda x: x["l_linestatus"])
    return g.join(table(spark, folder, "part").select("p_partkey"), "p_partkey").select("p_partkey", "lines", F.sort_array(F.transform(first, lambda x: x["l_linestatus"])).alias("states"))


@query("""
WITH h AS (SELECT q.vec_id AS query_id, b.vec_id AS id, b.label AS owner, q.label AS wanted, list_cosine_similarity(q.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 20 = 0),
own AS (SELECT query_id, id, owner, s, 0 AS pass_no FROM h WHERE owner = wanted QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 24),
every_one AS (SELECT query_id, id, owner, s, 1 AS pass_no FROM h QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) <= 24),
hits AS (SELECT * FROM (SELECT * FROM own UNION ALL SELECT * FROM every_one) QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY pass_no, s DESC) = 1),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY query_id, coalesce(CAST(owner AS VARCHAR), '#' || id) ORDER BY pass_no, s DESC, id) = 1)
SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pass_no, s DESC, id) AS INTEGER) AS rank FROM best QUALIFY rank <= 3""")
def owner_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """Three of different owners, searched once a pass: the query's own owner first, then all."""
    from millrace.plans.catalogue import recommendations

    return recommendations(spark, folder)


_TRIM = "regexp_replace(l, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')"
_HASH = f"left(md5(regexp_replace(regexp_replace(lower({_TRIM}), 'https?://\\S+', '', 'g'), '[\\s\\p{{Z}}]+', ' ', 'g')), 12)"


@query(f"""
WITH listed AS (SELECT * FROM (SELECT board_token, list_distinct(flatten(list(coalesce(boilerplate_hashes, [])))) AS hashes FROM pipeline_companies WHERE board_token IS NOT NULL GROUP BY board_token) WHERE len(hashes) > 0),
rest AS (SELECT doc_id, board_token, text FROM documents WHERE text IS NOT NULL AND board_token IS NOT NULL AND board_token NOT IN (SELECT board_token FROM listed)),
seen AS (SELECT DISTINCT doc_id, board_token, unnest(list_transform(list_filter(string_split(text, chr(10)), lambda l: length({_TRIM}) >= 30), lambda l: {_HASH})) AS line FROM rest),
n AS (SELECT board_token, count(DISTINCT doc_id) AS n FROM rest GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
found AS (SELECT board_token, list(line) AS hashes FROM (SELECT s.board_token, s.line FROM seen s JOIN n USING (board_token) GROUP BY 1, 2 HAVING count(*) > 0.4 * any_value(n.n)) GROUP BY 1),
c AS (SELECT * FROM listed UNION ALL SELECT * FROM found)
SELECT doc_id, length(array_to_string(list_filter(string_split(text, chr(10)), lambda l: length({_TRIM}) < 30 OR NOT list_contains(coalesce(hashes, []), {_HASH})), chr(10))) AS n_chars
FROM documents d LEFT JOIN c USING (board_token) WHERE text IS NOT NULL""")
def without_board_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Length of every text without its board's repeated lines, listed or computed."""
    from millrace.plans.catalogue import without_cached_lines

    return without_cached_lines(spark, folder)
