"""Column functions on strings: hashes, ids, slugs, markup, lines."""

from __future__ import annotations

import base64
import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.text import body_of, fold, strip_markup

#: White space at either end, as Unicode has it.
EDGES = r"(?U)^\s+|\s+$"


def nz(c: Column | str) -> Column:
    """Null for an empty string."""
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))


def first_of(*cs: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[nz(c) for c in cs])


def trimmed(c: Column | str) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, EDGES, "")


def squished(c: Column | str) -> Column:
    """Runs of white space as one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


@F.pandas_udf(T.StringType())
def plain_text(s: pd.Series) -> pd.Series:
    """Entities decoded twice and markup deleted; null stays null."""
    return s.map(lambda x: None if x is None else strip_markup(x))


@F.pandas_udf(T.StringType())
def plain_once(s: pd.Series) -> pd.Series:
    """Entities decoded once and markup deleted; null stays null."""
    return s.map(lambda x: None if x is None else strip_markup(x, 1))


@F.pandas_udf(T.StringType())
def raw_body(s: pd.Series) -> pd.Series:
    """The body of a raw posting, '' if it has none."""
    return s.map(body_of)


@F.pandas_udf(T.StringType())
def folded(s: pd.Series) -> pd.Series:
    """Names for look-up: ASCII, lower case, single spaces."""
    return s.map(fold)


def content_hash(title: Column, body: Column) -> Column:
    """SHA-256 of title, line break and body without markup, trimmed as a whole."""
    return F.sha2(trimmed(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit("")))), 256)


def record_id(source: Column, board: Column, own: Column) -> Column:
    """source__board__own, unless own has that form already."""
    return F.when(F.contains(own, F.lit("__")), own).otherwise(F.concat_ws("__", source, board, own))


def document_version(schema_version: str, content: Column, parsed_at: Column, group: Column, own_id: Column) -> Column:
    """MD5 over what decides whether a stored document is out of date."""
    stamp = F.date_format(parsed_at, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", F.lit(schema_version), F.coalesce(content, F.lit("")), F.coalesce(stamp, F.lit("")), F.coalesce(group, own_id)))


def url_safe_id(c: Column | str, prefix: str = "job_") -> Column:
    """Reversible identifier of letters, digits, - and _."""
    return F.concat(F.lit(prefix), F.rtrim(F.translate(F.base64(F.encode(c, "UTF-8")), "+/", "-_"), F.lit("=")))


def short_id(person: str, size: int = 10, length: int | None = None):
    """A function of a column: BLAKE2b digest of ``size`` bytes, keyed by ``person``, in lower-case base 32."""
    tag = person.encode()

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None:
                return None
            digest = hashlib.blake2b(x.encode(), digest_size=size, person=tag).digest()
            return base64.b32encode(digest).decode().rstrip("=").lower()[:length]

        return s.map(one)

    return run


def slug(c: Column | str, most: int = 120) -> Column:
    """Lower case, other than a-z and 0-9 as single hyphens, none at the ends, cut to ``most``."""
    dashed = F.regexp_replace(F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), "[^a-z0-9]+", "-")
    return F.left(F.regexp_replace(dashed, "^-+|-+$", ""), F.lit(most))


def host(c: Column | str) -> Column:
    """A domain's host: no scheme, path, port or leading www."""
    bare = F.regexp_replace(F.lower(trimmed(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))), "^https?://", "")
    return F.regexp_replace(F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit(":"), F.lit(1)), r"^www\.", "")


def domain_root(c: Column | str) -> Column:
    """The label before the public suffix; suffixes of two short labels count as one."""
    parts = F.filter(F.split(host(c), r"\."), lambda x: x != "")
    n = F.size(parts)
    double = (n >= 3) & (F.length(F.try_element_at(parts, F.lit(-1))) == 2) & (F.length(F.try_element_at(parts, F.lit(-2))) <= 3)
    return F.when(n == 0, "").when(n == 1, F.try_element_at(parts, F.lit(1))).when(double, F.try_element_at(parts, F.lit(-3))).otherwise(F.try_element_at(parts, F.lit(-2)))


def base_slug(name: Column, domain: Column, board: Column) -> Column:
    """The slug that a company would like: of its name, else its domain's root, else its board."""
    return F.coalesce(nz(slug(name)), nz(slug(domain_root(domain))), nz(slug(board)), F.lit("company"))


def identity_key(name: Column, domain: Column, source: Column, board: Column) -> Column:
    """What makes two boards one company: the same host, else the same name, else nothing."""
    h, s = host(domain), slug(name)
    return F.when(h != "", F.concat(F.lit("domain:"), h)).when(s != "", F.concat(F.lit("name:"), s)).otherwise(F.concat_ws(":", F.lit("row"), source, board))


def titled(c: Column | str) -> Column:
    """A board token as a name: hyphens and underscores as spaces, words capitalised."""
    return F.initcap(F.translate(c, "-_", "  "))


def line_text(c: Column | str) -> Column:
    """A line for comparison: lower case, trimmed, links dropped, spaces collapsed."""
    return squished(F.regexp_replace(F.lower(trimmed(c)), r"https?://\S+", ""))


def line_hash(c: Column | str) -> Column:
    """Twelve digits of the comparison form's MD5."""
    return F.left(F.md5(line_text(c)), F.lit(12))


def long_lines(c: Column | str, least: int = 30) -> Column:
    """The text's trimmed lines of at least ``least`` characters."""
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, EDGES, "")), lambda x: F.length(x) >= least)


def without_hashes(c: Column, hashes: Column, least: int = 30) -> Column:
    """The text without the lines of at least ``least`` trimmed characters whose hash is listed."""
    keep = lambda x: (F.length(F.regexp_replace(x, EDGES, "")) < least) | ~F.coalesce(F.array_contains(hashes, line_hash(x)), F.lit(False))
    return F.array_join(F.filter(F.split(c, "\n"), keep), "\n")


def without_first_lines(c: Column | str, n: int = 5) -> Column:
    """The text after its first n lines."""
    parts = F.split(c, "\n")
    return F.array_join(F.slice(parts, F.lit(n + 1), F.greatest(F.size(parts) - n, F.lit(0))), "\n")


def without_query(c: Column | str) -> Column:
    """A link without query and fragment."""
    return F.regexp_replace(c, "[?#].*", "")


def icon_link(domain: Column, company_slug: Column, form: str = "https://icons.example/{}") -> Column:
    """Where a company's icon would be: by its host, else its slug."""
    before, _, after = form.partition("{}")
    return F.concat(F.lit(before), F.coalesce(nz(host(domain)), F.concat(company_slug, F.lit(".com"))), F.lit(after))


def language_text(c: Column | str, most: int = 5000) -> Column:
    """Text for telling its language: reference codes dropped, spaces collapsed, cut."""
    return F.left(trimmed(squished(F.regexp_replace(c, r"\b[A-Z]{2,}\d+[A-Z0-9]*\b", " "))), F.lit(most))
