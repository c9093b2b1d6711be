import collections
import json
import random

import numpy as np

from millrace.llm import lines
from millrace.text import body_of

JOBS = "id string, ats string, board_token string, raw_json string, source string, chunk string, keys string"


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], JOBS)
    return {tuple(r) for r in lines.repeated_lines(lines.posting_lines(df), **options).collect()}


def expected(rows):
    jobs = {r[0]: r for r in rows if r[0] is not None}
    counts, sizes, own = collections.defaultdict(collections.Counter), collections.Counter(), {}
    for i, ats, board, raw in jobs.values():
        body = body_of(raw)
        if body.strip():
            keys = [lines.line_key(x) for x in body.split("\n")]
            sizes[ats, board] += 1
            counts[ats, board].update({k for k in keys if k is not None})
            own[i] = (ats, board), keys
    return {(i, n) for i, (b, keys) in own.items() if sizes[b] >= 5 for n, k in enumerate(keys) if k is not None and counts[b][k] > 0.4 * sizes[b]}


def posting(*parts):
    return json.dumps({"content": "\n".join(parts)})


def test_boards_of_all_sizes_and_chunks(spark):
    r = random.Random(2)
    legal = [f"We are an equal opportunity employer, clause {'abcdefgh'[k]} of our statement" for k in range(8)]
    rows = []
    for b, n in (("big", 400), ("five", 5), ("four", 4), (None, 12)):
        for i in range(n):
            text = [f"Own line of job {chr(97 + i % 26)}{chr(97 + i // 26)} with enough letters {b}"]
            for k, line in enumerate(legal):
                if r.random() < (0.2 + 0.1 * k):
                    text.insert(r.randrange(len(text) + 1), line if r.random() < 0.5 else f"  {line.upper()}  12 ")
            rows.append((f"{b}-{i}", "x", b, posting(*text)))
    rows += rows[:40]
    want = expected(rows)
    assert want and found(spark, rows) == want == found(spark, rows, chunk=50)


def test_rules_of_lines():
    same = lines.line_key("Read more at https://a.example/x and apply today please")
    assert same == lines.line_key("  READ more, at http://b.example/y?z and apply -- today 9 please!  ") is not None
    assert lines.line_key("short line") is None and lines.line_key("12345 67890 12345 67890 12345 67890") is None
    assert lines.line_key("Straße und Größe der Wohnung im Süden") == lines.line_key("STRASSE UND GRÖSSE DER WOHNUNG IM SÜDEN".replace("STRASSE", "straße").replace("GRÖSSE", "größe"))


def test_nulls_blanks_empty_tables_and_long_texts(spark):
    line = "This very line is found in every one of the postings"
    rows = [(f"j{i}", "a", "b", posting(line, "x" * 200_000 if i == 0 else "")) for i in range(5)] + [(None, "a", "b", posting(line)), ("n", "a", "b", None), ("m", "a", "b", "{broken"), ("e", "a", "b", posting(" "))]
    assert found(spark, rows) == {(f"j{i}", 0) for i in range(5)}
    assert found(spark, []) == set()


def test_blocks_by_suffix_array_match_brute_force():
    r = np.random.default_rng(4)
    for _ in range(60):
        docs = [r.integers(0, 4, r.integers(0, 9)) for _ in range(r.integers(1, 9))]
        got = dict(lines.repeated_blocks(docs, 0.4))
        count = collections.Counter()
        for d in docs:
            count.update({tuple(d[a:b].tolist()) for a in range(len(d)) for b in range(a + 1, len(d) + 1)})
        often = {b: n for b, n in count.items() if n > 0.4 * len(docs)}
        maximal = {b: n for b, n in often.items() if not any(len(c) == len(b) + 1 and m == n and b in (c[1:], c[:-1]) for c, m in often.items())}
        assert got == maximal


def test_bodies_lose_exactly_the_lines(spark):
    texts = spark.createDataFrame([("a", "x\ny\nz"), ("b", "x"), ("c", None)], "id string, text string")
    removed = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0)], "id string, line_no int")
    assert {r["id"]: (r["text"], r["lines_removed"]) for r in lines.without_lines(texts, removed).collect()} == {"a": ("x", 2), "b": ("", 1), "c": (None, 0)}


def test_blocks_are_counted_over_the_whole_source(spark):
    r = random.Random(5)
    base = [(f"a{i}", "many", [1, 2, 3, 4] if r.random() < 0.42 else [r.randrange(5, 9) for _ in range(r.randrange(1, 7))]) for i in range(60)]
    base += [(f"b{i}", None, ([10, 11, 12] if r.random() < 0.5 else [11, 12, 13]) + [100 + i]) for i in range(30)]
    base += [(f"c{i}", "few", [1, 2, 1, 2] if i % 2 else [2, 1]) for i in range(8)] + [(f"d{i}", "four", [1]) for i in range(4)] + [("c8", "few", [])]
    df = spark.createDataFrame([(i, s, k, list(range(len(k)))) for i, s, k in base], lines.LINES)
    want = set()
    for source in ("many", None, "few"):
        own = [k for _, s, k in base if s == source]
        many = collections.Counter(b for k in own for b in {tuple(k[i:j]) for i in range(len(k)) for j in range(i + 1, len(k) + 1)})
        often = {b: n for b, n in many.items() if n > 0.4 * len(own)}
        want |= {(source, b) for b, n in often.items() if not any(often.get(x) == n for x in often if len(x) == len(b) + 1 and b in (x[1:], x[:-1]))}
    for chunk in (5, 9, 4000):
        got = [(x["source"], tuple(x["block"])) for x in lines.counted_blocks(df, chunk=chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert {(x["source"], tuple(x["block"])) for x in lines.frequent_blocks(df, chunk=5).collect()} != want
