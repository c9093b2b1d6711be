"""Freely typed values mapped to a canonical list.

Method: a symmetric-delete dictionary.  Every name of the list is stored under itself and under all
strings that deleting up to a few letters leaves; a typed name within that many edits shares one of
them.  Candidates found so are ranked by weighted Damerau-Levenshtein distance, by what the other
typed fields say, and by the reference's own frequency (population).  Values that match nothing are
reported as such.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.text import fold

#: Strings (names, and what deletions leave of them) of a dictionary that is sent to every worker, at most: about 200 bytes
#: each there.  Larger lists are joined.
MOST_STRINGS = 1_500_000
#: Kinds of places, from the most specific (fixed values).
LOCALITY, ADMIN1, COUNTRY = "locality", "admin1", "country"

#: Short forms of the first or last words of names.
SHORT = {"n": "north", "s": "south", "e": "east", "w": "west", "st": "saint", "ste": "saint", "ft": "fort", "mt": "mount", "pt": "port", "pto": "puerto"}
#: Words around a name that are no part of it.
AROUND = frozenset("near greater metro area region hq headquarters onsite hybrid remote office offices campus site state province county city of the metropolitan downtown in based central floor anywhere nationwide across throughout within all 1st 2nd 3rd 4th 5th".split())
#: Whole entries that name no place.
NOWHERE = frozenset(
    "remote|anywhere|worldwide|flexible|multiple locations|various|various locations|tbd|tba|n a|na|none|unknown|on the road|client site|see description|home office|work from home|distributed|global".split("|")
)
_PIECES = re.compile(r"[,;/|>()\n]|\s[-–—]\s|:\s")
_CODE = re.compile(r"[A-Za-z]{2}")


#: Edits that count as a slip of the pen.
SLIP = 1


def allowed(length: int, most: int = SLIP) -> int:
    """Edits by which a typed name of that many letters may differ: none below 4, else ``most``, but at most one below 9 and two below 14."""
    return 0 if length < 4 else min(1, most) if length < 9 else min(2, most) if length < 14 else most


def deletes(word: str, most: int) -> set[str]:
    """The word and everything left after deleting up to ``most`` of its letters."""
    out, front = {word}, {word}
    for _ in range(most):
        front = {w[:i] + w[i + 1 :] for w in front for i in range(len(w))}
        out |= front
    return out


_VOWELS = frozenset("aeiouy")


def distance(a: str, b: str, most: int) -> tuple[int, float]:
    """(edits, weight): the fewest Damerau-Levenshtein steps from a to b (adjacent letters swapped count once), and the least weight of so many.

    Weights: a doubled letter dropped or added 0.5, a swap 0.7, a vowel for a vowel 0.8, any other edit 1,
    and 0.3 more at the first letter.  Lengths that differ by more than ``most`` give most + 1.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1, most + 1.0
    rows: list[list[tuple[int, float]]] = [[(0, 0.0)] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        rows[i][0] = (i, i + 0.3)
    for j in range(1, len(b) + 1):
        rows[0][j] = (j, j + 0.3)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            first = 0.3 if i == 1 or j == 1 else 0.0
            n, w = rows[i - 1][j - 1]
            best = (n, w) if x == y else (n + 1, w + first + (0.8 if x in _VOWELS and y in _VOWELS else 1.0))
            n, w = rows[i - 1][j]
            best = min(best, (n + 1, w + first + (0.5 if i > 1 and a[i - 2] == x else 1.0)))
            n, w = rows[i][j - 1]
            best = min(best, (n + 1, w + first + (0.5 if j > 1 and b[j - 2] == y else 1.0)))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                n, w = rows[i - 2][j - 2]
                best = min(best, (n + 1, w + 0.7))
            rows[i][j] = best
    return rows[-1][-1]


@dataclass
class Place:
    """An entry of the reference list."""

    key: int
    kind: str
    names: tuple[str, ...]
    country: str
    admin1: str
    population: int


@dataclass
class Dictionary:
    """Reference entries by name and by what deletions leave of their names."""

    places: list[Place]
    by_name: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    by_rest: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    most: int = SLIP

    def __post_init__(self) -> None:
        self.country_codes: dict[str, int] = {}
        self.admin1_codes: dict[str, list[int]] = defaultdict(list)
        for n, p in enumerate(self.places):
            for name in p.names:
                if n not in self.by_name[name]:
                    self.by_name[name].append(n)
            if p.kind == COUNTRY and p.country:
                self.country_codes[p.country.upper()] = n
            if p.kind == ADMIN1 and p.admin1:
                self.admin1_codes[p.admin1.upper()].append(n)
        for name in self.by_name:
            for rest in deletes(name, allowed(len(name) + self.most, self.most)):
                self.by_rest[rest].add(name)

    def find(self, name: str, kinds: tuple[str, ...]) -> list[tuple[float, int]]:
        """(weight, place) of the entries of those kinds nearest to a folded name; all that share the fewest edits."""
        if not name:
            return []
        exact = [n for n in self.by_name.get(name, ()) if self.places[n].kind in kinds]
        if exact:
            return [(0.0, n) for n in exact]
        most = allowed(len(name), self.most)
        if not most:
            return []
        near: dict[str, tuple[int, float]] = {}
        for rest in deletes(name, most):
            for other in self.by_rest.get(rest, ()):
                if other not in near:
                    near[other] = distance(name, other, most)
        found = [(edits, weight, n) for other, (edits, weight) in near.items() if edits <= most for n in self.by_name[other] if self.places[n].kind in kinds]
        if not found:
            return []
        fewest = min(f[0] for f in found)
        return [(w, n) for e, w, n in found if e == fewest]


def forms(piece: str) -> list[str]:
    """Folded names that a piece of a typed value may hold, the fullest first."""
    words = fold(piece).split()
    if not words or " ".join(words) in NOWHERE:
        return []
    out = [" ".join(words)]
    kept = [w for w in words if w not in AROUND and not w.isdigit()]
    if kept and kept != words:
        out.append(" ".join(kept))
    if kept and (kept[0] in SHORT or kept[-1] in SHORT):
        spelled = [SHORT.get(w, w) if k in (0, len(kept) - 1) else w for k, w in enumerate(kept)]
        out.append(" ".join(spelled))
    return list(dict.fromkeys(o for o in out if o))


def _pieces(value: str | None) -> list[str]:
    if value is None:
        return []
    return [p.strip() for p in _PIECES.split(value) if p and p.strip()]


def resolve(d: Dictionary, label: str | None, city: str | None, state: str | None, country: str | None) -> int:
    """The index of the place that a typed row means; -1 when it names none.

    The most specific place named is meant; names that match exactly go before near ones in each
    piece; among places of one name those that the other fields point at, then the nearest spelling, then the most people.
    """
    found: list[tuple[float, int]] = []
    admin1: set[int] = set()
    countries: set[int] = set()

    def code(text: str, with_country: bool = True) -> bool:
        key = text.strip().upper()
        hit = False
        if with_country and key in d.country_codes:
            countries.add(d.country_codes[key])
            hit = True
        if key in d.admin1_codes:
            admin1.update(d.admin1_codes[key])
            hit = True
        return hit

    def name(piece: str, kinds: tuple[str, ...]) -> bool:
        best: list[tuple[float, int]] = []
        for form in forms(piece):
            hits = d.find(form, kinds)
            if hits and (not best or min(hits)[0] < min(best)[0]):
                best = hits
            if best and min(best)[0] == 0:
                break
        for w, n in best:
            kind = d.places[n].kind
            if kind == ADMIN1:
                admin1.add(n)
            if kind == COUNTRY:
                countries.add(n)
            found.append((w, n))
        return bool(best)

    every = (LOCALITY, ADMIN1, COUNTRY)
    for value in (label, city):
        for piece in _pieces(value):
            if _CODE.fullmatch(piece):
                code(piece)
                continue
            if name(piece, every):
                continue
            words = piece.split()
            if len(words) > 1 and _CODE.fullmatch(words[-1]) and code(words[-1]):
                name(" ".join(words[:-1]), every)
    for piece in _pieces(state):
        if not (_CODE.fullmatch(piece) and code(piece, False)):
            name(piece, (ADMIN1, COUNTRY))
    stated_codes: set[int] = set()
    for piece in _pieces(country):
        if _CODE.fullmatch(piece) and piece.upper() in d.country_codes:
            stated_codes.add(d.country_codes[piece.upper()])
        else:
            name(piece, (COUNTRY,))
    countries |= stated_codes
    codes = {d.places[n].country for n in countries}
    regions = {(d.places[n].country, d.places[n].admin1) for n in admin1}

    def rank(item: tuple[float, int]) -> tuple:
        w, n = item
        p = d.places[n]
        agrees = ((p.country, p.admin1) in regions) + (p.country in codes)
        return (-agrees, w, -p.population, p.key)

    for kind in every:
        own = [f for f in found if d.places[f[1]].kind == kind]
        if own:
            return min(own, key=rank)[1]
    if regions and (len(admin1) == 1 or codes):
        fitting = [n for n in admin1 if not codes or d.places[n].country in codes]
        if len(fitting) == 1:
            return fitting[0]
    if len(countries) == 1:
        return next(iter(countries))
    return -1


_COLUMNS = ["geoname_id", "kind", "canonical_name", "ascii_name", "search_names", "country_code", "admin1_code", "population"]
_PLACE = "geoname_id bigint, kind string, canonical_name string, ascii_name string, search_names array<string>, country_code string, admin1_code string, population bigint"


def place_of(r) -> Place:
    """A place from a row of the reference list."""
    names = dict.fromkeys(n for n in map(fold, (r["canonical_name"], r["ascii_name"], *(r["search_names"] or ()))) if n)
    return Place(r["geoname_id"], r["kind"], tuple(names), (r["country_code"] or "").upper(), (r["admin1_code"] or "").upper(), r["population"] or 0)


#: The dictionary that a worker built last, by its call's token: tasks of one worker share it.
_built: dict[str, Dictionary] = {}


def _shared(token: str, places: list[Place], slip: int) -> Dictionary:
    from millrace.llm import canonical  # the worker's own module: what it keeps outlives a task

    if token not in canonical._built:
        canonical._built.clear()
        canonical._built[token] = Dictionary(places, most=slip)
    return canonical._built[token]


def _resolved(batch: pa.RecordBatch, d: Dictionary, known: dict[tuple, int]) -> pa.RecordBatch:
    out = []
    for t in zip(*(batch.column(c).to_pylist() for c in ("label", "city", "state", "country_code"))):
        if t not in known:
            if len(known) > 100_000:
                known.clear()
            n = resolve(d, *t)
            known[t] = d.places[n].key if n >= 0 else 0
        out.append(known[t])
    return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.int64())], names=["id", "geoname_id"])


def lookup_keys(label: str | None, city: str | None, state: str | None, country: str | None, slip: int = SLIP) -> set[str]:
    """Everything under which a dictionary could hold what the row names: codes, and what deletions leave of its names."""
    out: set[str] = set()
    for value in (label, city, state, country):
        for piece in _pieces(value):
            words = piece.split()
            out |= {f"code {w.upper()}" for w in (piece, words[-1]) if _CODE.fullmatch(w)}
            for part in (piece, " ".join(words[:-1])):
                for form in forms(part):
                    out |= deletes(form, allowed(len(form), slip))
    return out


def place_keys(p: Place, slip: int = SLIP) -> set[str]:
    """The keys under which a dictionary holds a place."""
    out = {rest for n in p.names for rest in deletes(n, allowed(len(n) + slip, slip))}
    if p.kind == COUNTRY and p.country:
        out.add(f"code {p.country}")
    if p.kind == ADMIN1 and p.admin1:
        out.add(f"code {p.admin1}")
    return out


def mapped_by_join(rows: DataFrame, places: DataFrame, slip: int = SLIP) -> DataFrame:
    """The same as ``mapped`` for lists of any size: typed rows and places meet by a join on the dictionary's keys.

    Distinct typed values are looked up once; each is resolved in a dictionary of just the places it met.
    """

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for n, t in enumerate(zip(*(batch.column(c).to_pylist() for c in ("label", "city", "state", "country_code")))):
                own = sorted(lookup_keys(*t, slip))
                at += [n] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in ("value", "label", "city", "state", "country_code")), pa.array(keys, pa.string())], names=["value", "label", "city", "state", "country_code", "key"])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys = [], []
            for n, r in enumerate(batch.to_pylist()):
                own = sorted(place_keys(place_of(r), slip))
                at += [n] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in batch.columns), pa.array(keys, pa.string())], names=[*batch.schema.names, "key"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                d = Dictionary(sorted((place_of(p) for p in r["found"]), key=lambda p: p.key), most=slip)
                n = resolve(d, r["label"], r["city"], r["state"], r["country_code"])
                out.append(d.places[n].key if n >= 0 else 0)
            yield pa.RecordBatch.from_arrays([batch.column("value"), pa.array(out, pa.int64())], names=["value", "geoname_id"])

    fields = ["label", "city", "state", "country_code"]
    valued = rows.select("id", *fields, F.md5(F.to_json(F.struct(*fields))).alias("value"))
    distinct = valued.select("value", *fields).dropDuplicates(["value"])
    keys = distinct.mapInArrow(typed, "value string, label string, city string, state string, country_code string, key string")
    entries = places.select(*_COLUMNS).filter("geoname_id is not null").dropDuplicates(["geoname_id"]).mapInArrow(listed, f"{_PLACE}, key string")
    met = keys.join(entries.select("key", F.struct(*_COLUMNS).alias("place")), "key").groupBy("value").agg(F.first("label").alias("label"), F.first("city").alias("city"), F.first("state").alias("state"), F.first(keys["country_code"]).alias("country_code"), F.collect_set("place").alias("found"))
    answers = met.mapInArrow(answered, "value string, geoname_id bigint")
    return valued.join(answers, "value", "left").groupBy("id").agg(F.max(F.coalesce("geoname_id", F.lit(0))).alias("geoname_id"))


def _strings(places: DataFrame, slip: int) -> int:
    """About how many strings a dictionary of the list holds."""
    long = lambda n: sum((F.pow(n.cast("double"), k) / math.factorial(k) for k in range(1, slip + 1)), F.lit(1.0))
    names = F.flatten(F.array(F.array("canonical_name", "ascii_name"), F.coalesce("search_names", F.array().cast("array<string>"))))
    every = F.aggregate(F.array_distinct(names), F.lit(0.0), lambda a, x: a + long(F.coalesce(F.length(x), F.lit(0))))
    return int(places.agg(F.sum(every)).first()[0] or 0)


def mapped(typed: DataFrame, places: DataFrame, most: int = MOST_STRINGS, slip: int = SLIP) -> DataFrame:
    """For each typed row (id bigint, label, city, state, country_code) the place it means: (id, geoname_id), 0 for none.

    places: geoname_id, kind, canonical_name, ascii_name, search_names, country_code, admin1_code, population.  slip: by
    how many edits a typed name may differ from the one it means (fewer where it is short).  A list whose dictionary has
    at most about ``most`` strings is sent to the workers, which build the dictionary; a larger one is joined.  Repeated rows
    count once; of differing rows of one id the largest result stands.  Null, empty and very long values are
    fine; an empty reference list maps everything to 0.
    """
    rows = typed.select("id", "label", "city", "state", "country_code").filter("id is not null")
    entries = places.select(*_COLUMNS).filter("geoname_id is not null").dropDuplicates(["geoname_id"])
    if _strings(places, slip) > most:
        return mapped_by_join(rows, places, slip)
    sent = typed.sparkSession.sparkContext.broadcast(sorted((place_of(r) for r in entries.collect()), key=lambda p: p.key))  # at most ``most`` names

    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = _shared(token, sent.value, slip)
        known: dict[tuple, int] = {}
        for batch in batches:
            yield _resolved(batch, d, known)

    return rows.mapInArrow(run, "id bigint, geoname_id bigint").groupBy("id").agg(F.max("geoname_id").alias("geoname_id"))
