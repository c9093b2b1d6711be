import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.functions import extract, nested
from millrace.functions import text as tx
from millrace.functions import values as vl
from millrace.text import body_of, fold, strip_markup


@pytest.fixture(scope="module")
def one(spark):
    def run(value, *args, kinds=None):
        kinds = kinds or ["string"] * len(args)
        df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)))
        return df.select(value(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first()["v"]

    return run


def test_markup():
    assert strip_markup("&amp;lt;p&amp;gt;A &amp;amp; B&amp;lt;/p&amp;gt;") == "A & B"
    assert strip_markup(None) == "" and strip_markup("a<br/>b") == "ab" and strip_markup("1 < 2") == "1 < 2"
    assert body_of('{"content": "", "description": null, "descriptionHtml": "<p>x</p>"}') == "x"
    assert body_of("[1]") == body_of("{") == body_of(None) == body_of('{"content": 5}') == ""
    assert fold("  São-Paulo, ÜBER ") == "sao paulo uber"


def test_ids(one):
    want = hashlib.sha256(b"T\nbody").hexdigest()
    assert one(lambda a, b: tx.content_hash(a, b), " T", "body \n ") == want
    assert one(lambda a, b, c: tx.record_id(a, b, c), "x", "y", "z") == "x__y__z" and one(lambda a, b, c: tx.record_id(a, b, c), "x", "y", "p__q") == "p__q"
    assert one(lambda a: tx.slug(a), "  Ätna & Sons, Inc. ") == "tna-sons-inc" and len(one(lambda a: tx.slug(a), "ab" * 200)) == 120
    assert one(lambda a: tx.url_safe_id(a), "a?b>c~" * 20).startswith("job_") and "=" not in one(lambda a: tx.url_safe_id(a), "abcd")
    digest = one(lambda a: tx.short_id("tag")(a), "job")
    assert len(digest) == 16 and digest == one(lambda a: tx.short_id("tag")(a), "job") != one(lambda a: tx.short_id("other")(a), "job")


@pytest.mark.parametrize("domain, host, root", [("https://www.Acme.co.uk/x", "acme.co.uk", "acme"), ("jobs.acme.example:80", "jobs.acme.example", "acme"), ("acme", "acme", "acme"), ("", "", ""), (None, "", "")])
def test_domains(one, domain, host, root):
    assert one(lambda a: tx.host(a), domain) == host and one(lambda a: tx.domain_root(a), domain) == root


def test_lines(one):
    text = "keep\n  A long line that is repeated on every page https://x.example/1 \nend"
    h = one(lambda a: tx.line_hash(a), "a long line THAT is repeated on every page https://y.example")
    assert one(lambda a, b: tx.without_hashes(a, F.array(b)), text, h) == "keep\nend"
    assert one(lambda a: tx.without_first_lines(a, 2), "1\n2\n3\n4") == "3\n4" and one(lambda a: tx.without_first_lines(a), "1\n2") == ""


@pytest.mark.parametrize("value, want", [("2025-01-02T03:04:05Z", dt.datetime(2025, 1, 2, 3, 4, 5)), ("1735787045000", dt.datetime(2025, 1, 2, 3, 4, 5)), ("1735787045", dt.datetime(2025, 1, 2, 3, 4, 5)), ("2025-01-02", dt.datetime(2025, 1, 2)), ("soon", None), ("", None)])
def test_moments(one, value, want):
    assert one(lambda a: vl.moment(a).cast("timestamp_ntz"), value) == want


def test_posted_falls_through(one):
    assert one(lambda a: vl.posted_at(a).cast("timestamp_ntz"), '{"publishedAt": "bad", "createdAt": 1735787045000}') == dt.datetime(2025, 1, 2, 3, 4, 5)


def test_amounts(one):
    k = ["double", "double", "string", "double"]
    f = lambda a, b, c, d: vl.annual_range(a, b, c, d)
    assert tuple(one(f, 30.0, 0.0, "hourly", 1.0, kinds=k)) == (62400, 62400) and tuple(one(f, 9.0, 2.5, "annually", 1.0, kinds=k)) == (2, 9)
    assert one(f, 9.0, 2.0, "yearly?", 1.0, kinds=k) is None and one(f, 0.0, None, "annually", 1.0, kinds=k) is None
    assert one(lambda a, b, c: vl.per_unit(a, b, c), 0.5, 1.1, "GBP", kinds=["double", "double", "string"]) == 2.2


@pytest.mark.parametrize("low, high, want", [(None, None, ["0_2", "3_5", "6_9"]), (10, None, ["10_plus"]), (2, 6, ["0_2", "3_5", "6_9"]), (None, 12, ["0_2", "3_5", "6_9", "10_plus"])])
def test_buckets(one, low, high, want):
    assert one(lambda a, b: vl.year_buckets(a, b), low, high, kinds=["int", "int"]) == want


def test_codes(one):
    assert one(lambda a: vl.language_code(a), "en_GB") == "en" and one(lambda a: vl.language_code(a), "Deutsch") == "de" and one(lambda a: vl.language_code(a), "klingon") is None
    assert one(lambda a: vl.country_code(a, {"usa": "US"}), "USA") == "US" and one(lambda a: vl.country_code(a), "de") == "DE"
    assert one(lambda a: vl.language_code(a), "日本語") == "ja" and one(lambda a: vl.language_code(a), "pt-BR") == "pt" and one(lambda a: vl.country_code(a), "uk") == "GB" and one(lambda a: vl.country_code(a), "United  States") is None
    assert one(lambda a: vl.country_code(a), "united states") == "US" and one(lambda a: vl.country_code(a), "Nowhere") is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("Die Katze und der Hund für eine Maus mit unser", "de"), ("und der die das", None), ("Nuestro equipo busca una persona para las tardes con los", "es"),
        ("We will work with you and your team for the role", "en"), ("これは日本語です", "ja"), ("한국어 문장", "ko"), ("xyz " * 20, None), ("", None), (None, None),
        ("nous vous notre votre avec dans pour une", "fr"), ("con una team nostro della ruolo per qui", "it"), ("met voor een ons onze je jij rol", "nl"), ("com para uma das dos vaga equipe trabalho", "pt"),
    ],
)
def test_guessed_languages(one, text, want):
    assert one(lambda a: vl.guessed_language(a), text) == want


def test_tags_and_summaries(one):
    assert one(lambda a: extract.workplace_tag(a), "x #li-hybrid #LI-Remote") == "remote" and one(lambda a: extract.workplace_tag(a), "x") is None
    assert tuple(one(lambda a: extract.summary_range(a), "$150K - $1.2M, equity")) == (150000.0, 1200000.0) and one(lambda a: extract.summary_range(a), "none") is None


def test_json(one):
    assert one(lambda a, b: nested.merged_json(a, b), '{"a": 1, "b": 2}', '{"b": 3}') == '{"a": 1, "b": 3}' and one(lambda a, b: nested.merged_json(a, b), "[", None) is None
    assert [tuple(r) for r in one(lambda a, b: nested.differing_fields(a, b), '{"a": 1, "b": 2}', '{"b": 3, "a": 1, "c": null}')] == [("b", "2", "3")]
    assert one(lambda a: nested.canonical_json(a), '{"b": 1, "a": [2]}') == '{"a":[2],"b":1}'
    assert one(lambda a: nested.answer(a, "x int", "y int", lambda f: F.struct(f["x"].alias("y"))), '```json\n{"x": 4}\n```')["y"] == 4
    assert one(lambda a: nested.canonical_tags(a, F.array(F.lit("c"), F.lit("zz"), F.lit("a")), ["a", "b", "c"]), "c") == ["c", "a"]


def test_samples_are_the_same_again(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(60)], "g int, k int")
    a, b = (sorted(map(tuple, nested.sampled(d, ["g"], 5, "k").collect())) for d in (df, df.repartition(7)))
    assert a == b and len(a) == 15
