import itertools
import random

import pytest

from millrace.llm import canonical as ca

PLACES = [
    (1, "country", "Ruritania", "Ruritania", ["ruritania"], "RU", None, 1000),
    (2, "country", "Zubrowka", "Zubrowka", ["zubrowka"], "ZU", None, 900),
    (3, "admin1", "Strelsau Land", "Strelsau Land", ["strelsau land"], "RU", "SL", 500),
    (4, "locality", "Hentzau", "Hentzau", ["hentzau", "altstadthof"], "RU", "SL", 50),
    (5, "locality", "Hentzau", "Hentzau", ["hentzau"], "ZU", "NB", 80),
    (6, "locality", "North Größburg", "North Grossburg", ["north grossburg"], "ZU", "NB", 10),
    (7, "admin1", "Nebelsbad", "Nebelsbad", ["nebelsbad"], "ZU", "NB", 70),
    (8, "locality", "Tarlenheim", "Tarlenheim", None, "RU", "SL", None),
]
SCHEMA = "geoname_id bigint, kind string, canonical_name string, ascii_name string, search_names array<string>, country_code string, admin1_code string, population bigint"
ROWS = "id bigint, label string, city string, state string, country_code string, geoname_id string"


@pytest.mark.parametrize(
    "row, want",
    [
        (("Hentzau", None, None, None), 5), (("Hentzau, SL", None, None, None), 4), (("Hentzau (Strelsau Land/Ruritania)", None, None, None), 4),
        (("HENTZUA RU", None, None, None), 4), ((None, "hentzau", None, "ru"), 4), ((None, None, "Nebelsbad", "Zubrovka"), 7),
        (("Remote, Ruritania", None, None, None), 1), (("near N. Grossburg", None, None, None), 6), (("Onsite / Altstadthof", None, None, None), 4),
        (("Zubrowka; Tarlenhiem", None, None, None), 8), (("Tarlenheim office, 2nd floor", None, None, None), 8), (("Tarlenheim 40113", "", " ", None), 8),
        (("Atlantis", None, None, None), 0), (("Multiple locations", None, None, None), 0), ((None, None, None, None), 0), (("", "", "", ""), 0), (("-", None, None, None), 0), (("x" * 100_000, None, None, None), 0),
    ],
)
def test_typed_rows(spark, row, want):
    places = [ca.Place(k, kind, tuple(dict.fromkeys(map(ca.fold, [c, a, *(n or [])]))), cc or "", ad or "", pop or 0) for k, kind, c, a, n, cc, ad, pop in PLACES]
    d = ca.Dictionary(places)
    n = ca.resolve(d, *row)
    assert (places[n].key if n >= 0 else 0) == want


def test_tables(spark):
    places = spark.createDataFrame(PLACES, SCHEMA)
    typed = spark.createDataFrame([(1, "Hentzau, SL", None, None, None, "x"), (1, "Hentzau, SL", None, None, None, "x"), (2, None, None, None, None, "x"), (None, "Hentzau", None, None, None, "x")], ROWS)
    assert {tuple(r) for r in ca.mapped(typed, places).collect()} == {(1, 4), (2, 0)}
    assert {tuple(r) for r in ca.mapped(typed, places.limit(0)).collect()} == {(1, 0), (2, 0)}
    assert ca.mapped(typed.limit(0), places).count() == 0


def test_large_lists_are_joined_with_the_same_result(spark):
    places = spark.createDataFrame(PLACES, SCHEMA)
    r = random.Random(8)
    pieces = ["Hentzau", "HENTZUA", "SL", "ru", "Ruritania", "Nebelsbad", "near Tarlenheim", "N. Grossburg", "Atlantis", "Altstadthof XX", "Zubrowca", "", None]
    typed = spark.createDataFrame([(i, *(r.choice([", ".join(x for x in r.sample(pieces, 2) if x), r.choice(pieces)]) for _ in range(2)), r.choice(pieces), r.choice(pieces), "x") for i in range(300)], ROWS)
    small, joined = ({tuple(x) for x in ca.mapped(typed, places, most=m).collect()} for m in (100_000, 3))
    assert len(small) == 300 and small == joined


def osa(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_edits_and_lookup_match_brute_force():
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcd") for _ in range(n))
    for _ in range(500):
        a, b = word(r.randrange(0, 9)), word(r.randrange(0, 9))
        assert ca.distance(a, b, 9)[0] == osa(a, b)
    names = list({word(r.randrange(5, 12)) for _ in range(150)})
    d = ca.Dictionary([ca.Place(k, ca.LOCALITY, (n,), "", "", 0) for k, n in enumerate(names)])
    for _ in range(300):
        q = word(r.randrange(5, 12))
        near = {k for k, n in enumerate(names) if osa(q, n) <= 1}
        exact = {k for k in near if names[k] == q}
        assert {k for _, k in d.find(q, (ca.LOCALITY,))} == (exact or near)


@pytest.mark.parametrize("slip", [1, 2, 3])
def test_more_edits_on_request(spark, slip):
    r = random.Random(slip)
    word = lambda n: "".join(r.choice("abcdef") for _ in range(n))
    names = list({word(r.randrange(5, 18)) for _ in range(80)})
    places = spark.createDataFrame([(k + 1, "locality", n, n, None, "RU", None, k) for k, n in enumerate(names)], SCHEMA)
    typed = []
    for i in range(60):
        w = list(r.choice(names))
        for _ in range(r.randrange(0, 4)):
            at = r.randrange(len(w))
            w[at : at + 1] = r.choice([[], [w[at], "x"], ["y"]])
        typed.append("".join(w))
    rows = spark.createDataFrame([(i, t, None, None, None, "") for i, t in enumerate(typed)], ROWS)
    sent, joined = ({x["id"]: x["geoname_id"] for x in ca.mapped(rows, places, most=m, slip=slip).collect()} for m in (10**7, 1))
    assert sent == joined
    for i, t in enumerate(typed):
        edits = {k + 1: osa(t, n) for k, n in enumerate(names)}
        fewest = min(edits.values())
        if fewest <= ca.allowed(len(t), slip) and not (len(t) < 4):
            assert edits[sent[i]] == fewest
        else:
            assert sent[i] == 0
