"""Column functions on dates, amounts, arrays and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import first_of

#: Keys of a raw posting that hold its date or its application link, in order.
POSTED_KEYS = ("publishedAt", "first_published", "datePosted", "createdAt")
APPLY_KEYS = ("applyUrl", "apply_url", "application_url", "absolute_url", "hostedUrl", "url")
#: Periods in a year.
FACTORS = {"hourly": 2080, "weekly": 52, "monthly": 12, "annually": 1}


def moment(c: Column) -> Column:
    """A time from an epoch in seconds or milliseconds, or ISO text (UTC unless it says otherwise); null if neither."""
    number = F.when(F.regexp(c, F.lit(r"^\d+$")), F.try_to_number(c, F.lit("9" * 18)).cast("double"))
    seconds = F.when(number > 10_000_000_000, number / 1000).otherwise(number)
    stamp = F.timestamp_micros((seconds * 1_000_000).cast("bigint"))
    return F.coalesce(stamp, c.try_cast("timestamp"))


def posted_at(raw: Column, keys: tuple[str, ...] = POSTED_KEYS) -> Column:
    """The first usable time under the keys of a raw JSON text."""
    return F.coalesce(*[moment(F.trim(F.get_json_object(raw, f"$.{k}"))) for k in keys])


def apply_link(raw: Column, keys: tuple[str, ...] = APPLY_KEYS) -> Column:
    """The first link that isn't blank."""
    return first_of(*[F.trim(F.get_json_object(raw, f"$.{k}")) for k in keys])


def currency_code(c: Column) -> Column:
    """Three upper-case letters, or null."""
    up = F.upper(F.trim(c))
    return F.when(F.regexp(up, F.lit("^[A-Z]{3}$")), up)


def factor(period: Column) -> Column:
    """How often a year a period comes; null if unknown."""
    out = F.lit(None).cast("int")
    for name, n in FACTORS.items():
        out = F.when(period == name, F.lit(n)).otherwise(out)
    return out


def annual_range(low: Column, high: Column, period: Column, rate: Column) -> Column:
    """struct<low, high>: whole units a year at a rate, bounds filled in from each other and in order; null if unknown."""
    good = lambda x: F.when((x != 0) & ~F.isnan(x), x)
    by = factor(period) * rate
    a, b = F.rint(F.coalesce(good(low), good(high)) * by).cast("bigint"), F.rint(F.coalesce(good(high), good(low)) * by).cast("bigint")
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")))


def per_unit(units: Column, base_per_target: Column, code: Column, base: str = "EUR", target: str = "USD") -> Column:
    """Target currency for one unit of ``code``, from rates quoted per unit of ``base``."""
    return F.when(code == target, F.lit(1.0)).when(code == base, base_per_target).otherwise(base_per_target / units)


def year_buckets(low: Column, high: Column) -> Column:
    """Names of the ranges of years that low..high overlaps; a missing bound is open, but the last range needs a bound of ten."""
    name = lambda label, a, b: F.when((low.isNull() | (low <= b)) & (high.isNull() | (high >= a)), F.lit(label))
    last = F.when((high.isNull() & (low >= 10)) | (high >= 10), F.lit("10_plus"))
    return F.array_compact(F.array(name("0_2", 0, 2), name("3_5", 3, 5), name("6_9", 6, 9), last))


def region_key(country: Column, region: Column) -> Column:
    """country-region, null unless both are given."""
    return F.when((country != "") & (region != ""), F.concat_ws("-", country, region))


def usable_points(points: Column) -> Column:
    """Of an array of structs (lat, lng), the distinct ones with two finite numbers."""
    fine = lambda p: p["lat"].isNotNull() & p["lng"].isNotNull() & ~F.isnan(p["lat"]) & ~F.isnan(p["lng"]) & (F.abs(p["lat"]) < float("inf")) & (F.abs(p["lng"]) < float("inf"))
    return F.array_distinct(F.filter(points, fine))


def multi_point(points: Column) -> Column:
    """GeoJSON text of usable points, null without one."""
    kept = usable_points(points)
    pairs = F.transform(kept, lambda p: F.array(p["lng"], p["lat"]))
    return F.when(F.size(kept) > 0, F.to_json(F.struct(F.lit("MultiPoint").alias("type"), pairs.alias("coordinates"))))


#: Names of countries in filters.
COUNTRIES = {
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US", "ca": "CA", "canada": "CA", "mx": "MX", "mexico": "MX",
    "au": "AU", "australia": "AU", "nz": "NZ", "new zealand": "NZ", "gb": "GB", "uk": "GB", "united kingdom": "GB", "japan": "JP", "india": "IN",
    "sweden": "SE", "france": "FR", "germany": "DE", "netherlands": "NL", "spain": "ES", "argentina": "AR", "colombia": "CO", "panama": "PA", "peru": "PE", "portugal": "PT",
}

#: Names and codes of languages.
LANGUAGES = {
    "en": "en", "eng": "en", "english": "en", "fr": "fr", "fra": "fr", "fre": "fr", "french": "fr", "francais": "fr", "français": "fr",
    "de": "de", "deu": "de", "ger": "de", "german": "de", "deutsch": "de", "es": "es", "spa": "es", "spanish": "es", "espanol": "es", "español": "es",
    "it": "it", "italian": "it", "italiano": "it", "pt": "pt", "por": "pt", "portuguese": "pt", "português": "pt", "pt-br": "pt",
    "ja": "ja", "jpn": "ja", "japanese": "ja", "日本語": "ja", "zh": "zh", "zho": "zh", "chi": "zh", "chinese": "zh", "zh-cn": "zh", "zh-tw": "zh",
    "ko": "ko", "kor": "ko", "korean": "ko", "한국어": "ko", "nl": "nl", "dutch": "nl", "nederlands": "nl", "pl": "pl", "polish": "pl", "polski": "pl",
    "sv": "sv", "swe": "sv", "swedish": "sv", "svenska": "sv", "da": "da", "danish": "da", "dansk": "da", "no": "no", "norwegian": "no", "norsk": "no",
    "fi": "fi", "finnish": "fi", "suomi": "fi",
}

#: Frequent words that tell languages apart.
STOPWORDS = {
    "en": "the and for with you your will our this that team role".split(),
    "fr": "nous vous notre votre avec dans pour une des les est grâce chez rejoins poste".split(),
    "de": "und der die das mit für ein eine unser unsere rolle team".split(),
    "es": "con para una las los nuestro nuestra equipo puesto trabajo".split(),
    "pt": "com para uma das dos nosso nossa equipe vaga trabalho".split(),
    "it": "con per una della delle nostro nostra team ruolo posizione".split(),
    "nl": "met voor een ons onze team rol functie je jij".split(),
}
#: Words a text needs to be judged, and frequent ones among them.
LEAST_WORDS, LEAST_FREQUENT = 8, 4


def country_code(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """The code of a known name, else two letters upper-cased, else null."""
    v = F.trim(c)
    known = F.create_map(*[F.lit(x) for kv in {**COUNTRIES, **(aliases or {})}.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(v)), F.when(F.regexp(v, F.lit("^[A-Za-z]{2}$")), F.upper(v)))


def language_code(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """A language's two letters, lower case: of a tag such as en-GB its first part, of a known name its code; else null."""
    v = F.lower(F.trim(F.translate(c, "_", "-")))
    head = F.split_part(v, F.lit("-"), F.lit(1))
    known = F.create_map(*[F.lit(x) for kv in (aliases or LANGUAGES).items() for x in kv])
    return F.coalesce(F.try_element_at(known, v), F.try_element_at(known, head), F.when(F.regexp(head, F.lit("^[a-z]{2}$")), head))


def guessed_language(c: Column) -> Column:
    """Japanese or Korean by script, else the language with the most frequent words, the first on a tie; null for too few of them."""
    words = F.regexp_extract_all(F.lower(c), F.lit("([a-zà-ÿ]+)"), 1)

    def counted(own: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(own)))

    score = {k: counted(own) for k, own in STOPWORDS.items()}
    best = F.greatest(*score.values())
    out = F.lit(None).cast("string")
    for k in reversed(list(score)):
        out = F.when(score[k] == best, F.lit(k)).otherwise(out)
    scripted = F.when(F.regexp(c, F.lit("[\u3040-\u30ff]")), "ja").when(F.regexp(c, F.lit("[\uac00-\ud7af]")), "ko")
    return F.coalesce(scripted, F.when((F.size(words) >= LEAST_WORDS) & (best >= LEAST_FREQUENT), out))
