import random

import numpy as np

from millrace.llm import spans, winnow

SCHEMA = "doc bigint, text string, h string, pos string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows, span):
    texts = {d: t for d, t in rows if d is not None and t is not None}
    owner, many = {}, set()
    for d, t in texts.items():
        for s in range(len(t) - span + 1):
            if owner.setdefault(t[s : s + span], d) != d:
                many.add(t[s : s + span])
    out = set()
    for d, t in texts.items():
        runs = []
        for s in range(len(t) - span + 1):
            if t[s : s + span] in many:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + span
                else:
                    runs.append([s, s + span])
        out |= {(d, a, b) for a, b in runs}
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé😀 ") for _ in range(r.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(6)]
    rows = []
    for d in range(n):
        parts = []
        for _ in range(r.randrange(1, 6)):
            s = r.choice(shared)
            a = r.randrange(len(s) // 2)
            parts.append(r.choice([word(), s, s[a : a + r.randrange(20, 90)], "-" * r.randrange(3, 120), s.upper()]))
        rows.append((d, " ".join(parts)))
    return rows


def found(spark, rows, **options):
    df = frame(spark, rows)
    index = spans.SpanIndex(spark, **options)
    index.add(df)
    return {tuple(r) for r in index.spans(df).collect()}


def test_spans_match_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed) + [(1000, None), (1001, ""), (1002, "short"), (None, "x" * 300)]
        rows += rows[:3]
        want = expected(rows, 50)
        assert want and found(spark, rows, span=50, gram=16) == want


def test_batches_and_compaction_give_the_same(spark):
    rows = corpus(3)
    want = expected(rows, 50)
    parts = [frame(spark, rows[k::3]) for k in range(3)]
    index, got = spans.SpanIndex(spark, span=50, gram=16), []
    for k, part in enumerate(parts):
        n = index.add(part)
        so_far = frame(spark, [x for p in range(k + 1) for x in rows[p::3]])
        got.append(index.spans(so_far, since=n).selectExpr("doc", "span_start a", "span_end b"))
    every = got[0].unionByName(got[1]).unionByName(got[2])
    assert {tuple(r) for r in spans.merged(every).collect()} == want
    index.compact()
    assert len(index.runs) == 1 and {tuple(r) for r in index.spans(frame(spark, rows)).collect()} == want


def test_large_groups_take_the_distributed_way(spark, monkeypatch):
    monkeypatch.setattr(spans, "GROUP", 3)
    rows = corpus(5)
    assert found(spark, rows, span=50, gram=16) == expected(rows, 50)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    r = random.Random(9)
    body = "".join(r.choice("abcdefgh ") for _ in range(9000))
    rows = [(1, body), (2, "q" * 100 + body[3000:7000] + "r" * 50), (3, "z" * 5000)]
    monkeypatch.setattr(winnow, "PIECE", 512)
    batch = spark.createDataFrame(rows, "doc bigint, text string").toArrow().to_batches()
    small = sorted({x for b in spans._run_of(50, 16)(iter(batch)) for x in zip(*(b.column(c).to_pylist() for c in ("h", "doc", "pos", "c1", "c2")))})
    monkeypatch.setattr(winnow, "PIECE", 1 << 20)
    whole = sorted({x for b in spans._run_of(50, 16)(iter(batch)) for x in zip(*(b.column(c).to_pylist() for c in ("h", "doc", "pos", "c1", "c2")))})
    assert small == whole


def test_empty_table_and_shares(spark):
    assert found(spark, []) == set()
    s = spark.createDataFrame([(1, 0, 50), (1, 60, 110)], "doc bigint, span_start int, span_end int")
    out = {r["doc"]: (r["n_spans"], r["share"]) for r in spans.shared_share(spark.createDataFrame([(1, "x" * 200), (2, "")], "doc bigint, text string"), s).collect()}
    assert out == {1: (2, 0.5), 2: (0, 0.0)}


def test_sliding_extremes():
    x = np.random.default_rng(0).integers(0, 1 << 60, 400).astype(np.uint64)
    for w in (1, 7, 64, 400):
        assert (winnow.sliding(x, w, np.minimum, (1 << 64) - 1) == [x[i : i + w].min() for i in range(len(x) - w + 1)]).all()
