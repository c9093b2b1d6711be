"""Long exact spans shared between texts.

Method: a log-structured index of window hashes.  Every batch of texts leaves an immutable run: the hashes of its
anchors (``winnow``), dealt to buckets by hash and sorted within them.  All runs have the same buckets, so a new batch
is merge-joined with the runs of history bucket by bucket, without moving them, to find the anchors that stand in more than
one text.  Runs of like size are merged into one (``tidy``), which moves nothing either, and the old ones deleted.

Equal windows have equal anchors at equal places, so only windows around shared anchors are looked at:

* occurrences of an anchor with the same surroundings (all windows around it, up to the text's ends) form a
  class, named by a 128-bit digest of that stretch of the text itself, which the window hashes take no part in; a class in
  two texts is shared as a whole, whatever its number of texts;
* classes that differ are compared window by window, text against text, only where a long part in the middle of those
  windows agrees; groups of classes of any size are handled, large ones by a distributed aggregation.

A run holds one row for each class of a stretch of the batch, not one for each occurrence: a passage that stands in a third of
all texts, or a long row of one character, is combined before it is dealt to its bucket.  The places of the other
occurrences are kept beside the runs, so every anchor is stored once; what a step makes for itself is deleted when it ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.arrow import signed, slices, spread
from millrace.bloom import narrowed
from millrace.llm import winnow
from millrace.scratch import cut, discard, place, remove

SPAN, GRAM, PARTS = 200, 50, 3
#: Classes compared in one task; larger groups go through a distributed aggregation.
GROUP = 20_000
#: Runs of like size (a power of this number) that are merged into one.
FANOUT = 2

#: One row for each anchor; ``high`` only at the first of a class in a stretch of texts: the largest doc it has there.
ANCHORS = "h bigint, doc bigint, pos int, reach int, c1 bigint, c2 bigint, part0 smallint, part1 smallint, part2 smallint, high bigint"
_KINDS = dict(zip(("h", "doc", "pos", "reach", "c1", "c2", "part0", "part1", "part2"), (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int16, np.int16, np.int16)))


def _ranges(span: int, gram: int) -> list[tuple[int, int]]:
    """The offsets of an anchor in its windows, in PARTS ranges (first, last)."""
    edges = np.linspace(0, span - gram + 1, PARTS + 1).astype(int).tolist()
    return [(a, b - 1) for a, b in zip(edges[:-1], edges[1:])]


def _digests(text: str, low: np.ndarray, high: np.ndarray, left: np.ndarray) -> np.ndarray:
    """128 bits of each stretch [low, high) of the text and of the anchor's place in it, as two columns."""
    of = xxhash.xxh3_128_digest
    raw = b"".join(of(text[a:b].encode("utf-8", "surrogatepass"), n) for a, b, n in zip(low.tolist(), high.tolist(), left.tolist()))
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def _run_of(span: int, gram: int) -> Callable:
    side, ranges = span - gram, _ranges(span, gram)

    def piece(text: str, start: np.ndarray, end: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchors of texts laid end to end; start, end and which are given for each code point."""
        points = winnow.codes(text)
        hashed = winnow.Hashed(points)
        h = hashed.every(gram)
        w = side + 1
        valid = np.arange(len(points)) + span <= end
        at = winnow.anchors(h, valid[: len(h) - w + 1], w)
        s, e = start[at], end[at]
        low, high = np.maximum(s, at - side), np.minimum(e, at + span)
        digest = _digests(text, low, high, at - low)
        parts = []
        for first, last in ranges:
            a, b = at - first, at + span - last
            inside = (a >= s) & (b <= e)
            p = (hashed.of(np.where(inside, a, 0), np.where(inside, b, 0)) >> np.uint64(49)).astype(np.int16)
            parts.append(np.where(inside, p, np.int16(-1)))
        return signed(h[at]), which[at], at - s, (at - low) << 16 | (high - at), digest[:, 0], digest[:, 1], *parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", winnow.PIECE):
            docs, texts = batch.column("doc").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            long = [k for k, t in enumerate(texts) if len(t) > 4 * winnow.PIECE]
            found = []
            rest = [k for k, t in enumerate(texts) if span <= len(t) <= 4 * winnow.PIECE]
            if rest:
                sizes = np.array([len(texts[k]) for k in rest])
                ends = np.cumsum(sizes)
                found.append(piece("".join(texts[k] for k in rest), np.repeat(ends - sizes, sizes), np.repeat(ends, sizes), np.repeat(docs[rest], sizes)))
            for k in long:  # one text in overlapping stretches: each owns the anchors of the windows that start in it
                n, step = len(texts[k]), 2 * winnow.PIECE
                for a in range(0, n - span + 1, step):
                    b0, b1 = max(0, a - side), min(n, a + step + 2 * span)
                    m = b1 - b0
                    got = piece(texts[k][b0:b1], np.full(m, 0), np.full(m, m), np.full(m, docs[k]))
                    # anchors near a cut may have a cut surrounding; the neighbouring stretch has them whole
                    here = got[2] + b0
                    whole = ((here - side >= b0) | (b0 == 0)) & ((here + span <= b1) | (b1 == n))
                    got = (*got[:2], here, *got[3:])
                    found.append(tuple(x[whole] for x in got))
            if not found:
                continue
            columns = {name: np.concatenate(x).astype(_KINDS[name]) for name, x in zip(_KINDS, zip(*found))}
            order = np.lexsort((columns["doc"], columns["c2"], columns["c1"]))
            c1, c2, doc = (columns[c][order] for c in ("c1", "c2", "doc"))
            edge = np.flatnonzero(np.concatenate([[True], (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])])) if len(order) else order
            last = np.concatenate([edge[1:], [len(order)]]) - 1 if len(order) else order
            high, none = np.zeros(len(order), np.int64), np.ones(len(order), bool)
            high[order[edge]], none[order[edge]] = doc[last], False
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), pa.array(high, pa.int64(), mask=none)], names=[*columns, "high"])

    return run


def _slices_of(span: int, gram: int) -> Callable:
    """The surroundings of the wanted places of each text, for each group that compares them what its windows cover."""
    ranges = _ranges(span, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, docs, texts = [], [], []
            for doc, text, wanted in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
                for r in wanted:
                    for g in r["groups"]:
                        first, last = ranges[g["part"]]
                        left, right = min(r["reach"] >> 16, last), min(r["reach"] & 0xFFFF, span - first)
                        rows.append((r["h"], r["c1"], r["c2"], left << 16 | right, r["several"], g["part"], g["value"], g["n"]))
                        docs.append(doc)
                        texts.append(text[r["pos"] - left : r["pos"] + right])
            columns = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(docs, pa.int64()), pa.array(texts, pa.string())], names=["h", "c1", "c2", "reach", "several", "part", "value", "n", "doc", "slice"])

    return run


SLICES = "h bigint, c1 bigint, c2 bigint, reach int, several boolean, part int, value int, n bigint, doc bigint, slice string"


def _windows(batch: pa.RecordBatch | pa.Table, span: int, ranges: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset of the anchor, hash) of all windows of the rows' slices whose offset lies in the row's range."""
    texts = batch.column("slice").to_pylist()
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    hashed = winnow.Hashed(winnow.codes("".join(texts)))
    row = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(ends[-1] if len(ends) else 0)
    left = batch.column("reach").to_numpy() >> 16
    part = batch.column("part").to_numpy()
    first, last = np.array(ranges)[:, 0][part], np.array(ranges)[:, 1][part]
    offset = left[row] - (at - (ends - sizes)[row])
    ok = (at + span <= ends[row]) & (offset >= first[row]) & (offset <= last[row])
    at = at[ok]
    return row[ok], offset[ok], hashed.of(at, at + span)


def _shared_offsets(row: np.ndarray, offset: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive offsets marked ok, for each row: (row, smallest, largest)."""
    r, o = row[ok], offset[ok]
    if not len(r):
        return r, o, o
    order = np.lexsort((o, r))
    r, o = r[order], o[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (o[1:] != o[:-1] + 1)])
    start = np.flatnonzero(new)
    stop = np.concatenate([start[1:], [len(r)]]) - 1
    return r[start], o[start], o[stop]


def _same_text(texts: list[str], left: np.ndarray, row: np.ndarray, offset: np.ndarray, span: int, key: np.ndarray, order: np.ndarray, edge: np.ndarray, ok: np.ndarray) -> None:
    """Leaves ok only where a window's text is that of the window before or after it among those of one hash."""
    run = np.zeros(len(order), np.int64)
    run[edge] = 1
    run = np.cumsum(run)
    marked = np.flatnonzero(ok[order])
    rows, starts = row[order[marked]].tolist(), (left[row[order[marked]]] - offset[order[marked]]).tolist()
    own = [texts[r][a : a + span] for r, a in zip(rows, starts)]
    group = run[marked].tolist()
    first = {}
    for k, (g, w) in enumerate(zip(group, own)):
        first.setdefault((g, w), []).append(k)
    for members in first.values():
        if len(members) == 1:
            ok[order[marked[members[0]]]] = False


def _compared(span: int, gram: int) -> Callable:
    """Windows that classes of one group share, for groups that fit in a task; rows sorted by group."""
    ranges = _ranges(span, gram)

    def flush(t: pa.Table) -> pa.RecordBatch:
        row, offset, h = _windows(t, span, ranges)
        n = t.num_rows
        keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("h", "part", "value")], 1)
        group = np.cumsum(np.concatenate([[0], (keys[1:] != keys[:-1]).any(1)]))
        doc, several = t.column("doc").to_numpy(), t.column("several").to_numpy(zero_copy_only=False)
        key = winnow.mix(h + group[row].astype(np.uint64) * np.uint64(winnow.BASE))
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
        ok = np.zeros(len(row), bool)
        if len(edge):
            d, s = doc[row[order]], several[row[order]]
            many = (np.minimum.reduceat(d, edge) < np.maximum.reduceat(d, edge)) | (np.maximum.reduceat(s.astype(np.int8), edge) > 0)
            ok[order] = np.repeat(many, np.diff(np.concatenate([edge, [len(key)]])))
            _same_text(t.column("slice").to_pylist(), t.column("reach").to_numpy() >> 16, row, offset, span, key, order, edge, ok)
        ok &= ~several[row]
        r, low, high = _shared_offsets(row, offset, ok)
        take = pa.array(r)
        return pa.RecordBatch.from_arrays([t.column("c1").combine_chunks().take(take), t.column("c2").combine_chunks().take(take), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["c1", "c2", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < 4000:
                continue
            t = pa.Table.from_batches(held)
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("h", "part", "value")], 1)
            last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            for a, b in _cuts(keys[:last]):
                yield flush(t.slice(a, b - a))
            held, size = t.slice(last).to_batches(), t.num_rows - last
        if held:
            t = pa.Table.from_batches(held)
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("h", "part", "value")], 1)
            for a, b in _cuts(keys):
                yield flush(t.slice(a, b - a))

    return run


def _cuts(keys: np.ndarray, most: int = 8000) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups, of ``most`` rows or one group each."""
    n = len(keys)
    edges = [*np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])).tolist(), n] if n else []
    a = 0
    for e, following in zip(edges[1:], [*edges[2:], None]):
        if following is None or following - a > most:
            yield a, e
            a = e


def _exploded(span: int, gram: int) -> Callable:
    """Every window of the rows with a digest of its text."""
    ranges = _ranges(span, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                part = batch.slice(a, 4000)
                row, offset, _ = _windows(part, span, ranges)
                texts, left = part.column("slice").to_pylist(), part.column("reach").to_numpy() >> 16
                of = xxhash.xxh3_128_digest
                raw = b"".join(of(texts[r][n : n + span].encode("utf-8", "surrogatepass")) for r, n in zip(row.tolist(), (left[row] - offset).tolist()))
                window = np.frombuffer(raw, "<i8").reshape(-1, 2)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in ("h", "c1", "c2", "several", "doc")), pa.array(offset.astype(np.int32)), pa.array(window[:, 0]), pa.array(window[:, 1])], names=["h", "c1", "c2", "several", "doc", "offset", "w1", "w2"])

    return run


class SpanIndex:
    """An index of texts for spans of at least ``span`` code points that stand in several of them.

    Texts are rows (doc bigint, text string); null texts, and texts shorter than ``span``, share
    nothing.  doc identifies a text: repeated rows of one doc are one text.  buckets: the number that every run is
    dealt to; without it as many as the session has shuffle partitions.
    """

    def __init__(self, spark: SparkSession, span: int = SPAN, gram: int = GRAM, buckets: int | None = None) -> None:
        if not 0 < gram < span or span - gram >= 1 << 15:
            raise ValueError("gram must be shorter than span, by less than 32768")
        self.spark, self.span, self.gram = spark, span, gram
        self.buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        self.runs: list[tuple[str, int, int]] = []  # table, first batch, number of rows
        self.batches = 0
        self.rest: list[DataFrame] = []  # places (c1, c2, doc, pos) of the anchors that no run has

    def add(self, texts: DataFrame) -> int:
        """Write the anchors of a batch and their hashes as a run; returns the batch's number."""
        own = spread(texts.select(F.col("doc").cast("bigint").alias("doc"), "text").filter((F.length("text") >= self.span) & F.col("doc").isNotNull()))
        anchors = cut(own.mapInArrow(_run_of(self.span, self.gram), ANCHORS), "anchors")
        number, self.batches = self.batches, self.batches + 1
        self._write(anchors.filter("high is not null").withColumn("batch", F.lit(number)).repartition(self.buckets, "h"), number)
        self.rest.append(cut(anchors.filter("high is null").select("c1", "c2", "doc", "pos"), "rest"))
        discard(anchors)
        return number

    def _write(self, rows: DataFrame, batch: int) -> None:
        name = f"millrace_run_{uuid.uuid4().hex}"
        rows.sortWithinPartitions("h", "c1", "c2").write.option("path", place(self.spark, "run")).option("compression", "zstd").bucketBy(self.buckets, "h").sortBy("h").saveAsTable(name)
        self.runs.append((name, batch, self.spark.table(name).count()))

    def tidy(self, fanout: int = FANOUT) -> None:
        """Merge the newest runs while ``fanout`` of them are of like size: bucket by bucket, then delete them."""
        size = lambda rows: max(rows, 1).bit_length() // max(fanout.bit_length() - 1, 1)
        while len(self.runs) >= fanout and all(size(r[2]) >= size(self.runs[-fanout][2]) for r in self.runs[-fanout:]):
            self._merge(fanout)

    def compact(self) -> None:
        """Merge all runs into one."""
        if len(self.runs) > 1:
            self._merge(len(self.runs))

    def _merge(self, many: int) -> None:
        old, self.runs = self.runs[-many:], self.runs[:-many]
        least = F.min(F.struct("doc", "pos", "reach", *[f"part{i}" for i in range(PARTS)])).alias("first")
        # a union of tables of the same buckets keeps them, and so does the aggregation
        rows = reduce(DataFrame.unionByName, [self.spark.table(name) for name, *_ in old])
        merged_rows = rows.groupBy("h", "c1", "c2").agg(least, F.max("high").alias("high"), F.max("batch").alias("batch")).select("h", "first.doc", "first.pos", "first.reach", "c1", "c2", *[f"first.part{i}" for i in range(PARTS)], "high", "batch")
        self._write(merged_rows, old[0][1])
        others = F.row_number().over(Window.partitionBy("h", "c1", "c2").orderBy("doc", "pos")) > 1  # all but the first, which the merged run has
        self.rest.append(cut(rows.select("h", "c1", "c2", "doc", "pos", others.alias("other")).filter("other").select("c1", "c2", "doc", "pos"), "rest"))
        for name, *_ in old:
            path = self.spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
            self.spark.sql(f"DROP TABLE {name}")
            remove(self.spark, path)

    def _classes(self, since: int) -> DataFrame:
        """Classes of the anchors that stand in several texts, one of them of batch ``since`` or later.

        The new run is merge-joined with every earlier one bucket by bucket; of the runs' rows only those of shared anchors move.
        """
        new = [self.spark.table(name) for name, first, _ in self.runs if first >= since]
        old = [self.spark.table(name) for name, first, _ in self.runs if first < since]
        bounds = lambda rows: rows.groupBy("h").agg(F.min("doc").alias("low"), F.max("high").alias("top"))
        least, most = bounds(reduce(DataFrame.unionByName, new)), F.col("top")
        low = F.col("low")
        for k, rows in enumerate(old):
            least = least.join(bounds(rows).toDF("h", f"low{k}", f"top{k}").hint("merge"), "h", "left")
            low, most = F.least(low, f"low{k}"), F.greatest(most, f"top{k}")
        shared = cut(least.filter(low < most).select("h"), "shared")
        first = F.min(F.struct("doc", "pos", "reach", *[f"part{i}" for i in range(PARTS)])).alias("first")
        own = reduce(DataFrame.unionByName, [rows.join(shared, "h", "left_semi") for rows in [*new, *old]])
        own = own.groupBy("h", "c1", "c2").agg(first, F.max("high").alias("high"), F.max("batch").alias("last"))
        classes = cut(own.select("h", "c1", "c2", "first.*", (F.col("first.doc") < F.col("high")).alias("several"), (F.col("last") >= since).alias("fresh")), "classes")
        discard(shared)
        return classes

    def found(self, texts: DataFrame, since: int = 0) -> DataFrame:
        """What is shared of each class: rows (c1, c2, a, b), a stretch from a to b around its anchors.

        texts: all indexed texts, to confirm with; those of shared places are read.  since: only what is shared through
        a text of that batch or a later one, which must be in runs of their own; together with what was found before, that is all that is shared.
        """
        if not self.runs:
            return self.spark.createDataFrame([], "c1 bigint, c2 bigint, a int, b int")
        ends = [first - 1 for _, first, _ in self.runs[1:]] + [self.batches - 1]
        if any(first < since <= end for (_, first, _), end in zip(self.runs, ends)):
            raise ValueError(f"batch {since} is merged with earlier ones")
        classes = self._classes(since)
        left, right = F.shiftright("reach", 16), F.col("reach").bitwiseAND(0xFFFF)
        whole = classes.filter("several and fresh").filter(left + right >= self.span).select("c1", "c2", (-left).alias("a"), right.alias("b"))
        parts = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("part"), F.col(f"part{i}").cast("int").alias("value")) for i in range(PARTS)]), lambda x: x["value"] >= 0)).alias("p")
        members = classes.select("h", "c1", "c2", "doc", "pos", "reach", "several", "fresh", parts).select("h", "c1", "c2", "doc", "pos", "reach", "several", "fresh", "p.part", "p.value")
        sizes = members.groupBy("h", "part", "value").agg(F.count("*").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.max("several").alias("some"), F.min("several").alias("every"), F.max("fresh").alias("fresh"))
        alike = members.drop("fresh").join(sizes.filter("n > 1 and (low < high or some) and not every and fresh").select("h", "part", "value", "n"), ["h", "part", "value"])
        # a class's text is read once, from its first text; a text's wanted places are as many as it has anchors at most
        grouped = alike.groupBy("doc", "pos", "h", "c1", "c2", "reach", "several").agg(F.collect_list(F.struct("part", "value", "n")).alias("groups"))
        wanted = cut(grouped.groupBy("doc").agg(F.collect_list(F.struct("h", "c1", "c2", "pos", "reach", "several", "groups")).alias("wanted"), F.max(F.array_max("groups.n")).alias("most")), "wanted")
        read = narrowed(texts.select(F.col("doc").cast("bigint").alias("doc"), "text").filter((F.length("text") >= self.span) & F.col("doc").isNotNull()), "doc", wanted)
        rows = read.join(wanted.select("doc", "wanted"), "doc").mapInArrow(_slices_of(self.span, self.gram), SLICES)
        large = not wanted.filter(F.col("most") > GROUP).isEmpty()
        used = [classes, wanted]
        if large:
            used.append(cut(rows, "slices"))
            rows = used[-1].dropDuplicates(["c1", "c2", "part", "value"])
        few = rows.filter(F.col("n") <= GROUP) if large else rows
        common = few.repartition("h", "part", "value").sortWithinPartitions("h", "part", "value").mapInArrow(_compared(self.span, self.gram), "c1 bigint, c2 bigint, low int, high int")
        if large:
            windows = rows.filter(F.col("n") > GROUP).mapInArrow(_exploded(self.span, self.gram), "h bigint, c1 bigint, c2 bigint, several boolean, doc bigint, offset int, w1 bigint, w2 bigint")
            repeated = windows.groupBy("h", "w1", "w2").agg(F.min("doc").alias("x"), F.max("doc").alias("y"), F.max("several").alias("s")).filter("x < y or s").select("h", "w1", "w2")
            common = common.unionByName(windows.filter("not several").join(repeated, ["h", "w1", "w2"], "left_semi").select("c1", "c2", F.col("offset").alias("low"), F.col("offset").alias("high")))
        out = cut(whole.unionByName(common.select("c1", "c2", (-F.col("high")).alias("a"), (F.lit(self.span) - F.col("low")).alias("b"))), "found")
        discard(*used)
        return out

    def located(self, found: DataFrame) -> DataFrame:
        """Shared stretches (doc, span_start, span_end) of all indexed texts, from what was found of their classes."""
        if not self.runs:
            return self.spark.createDataFrame([], "doc bigint, span_start int, span_end int")
        places = reduce(DataFrame.unionByName, [self.spark.table(name).select("c1", "c2", "doc", "pos") for name, *_ in self.runs] + self.rest)
        known = cut(found.select("c1").distinct(), "known")
        located = narrowed(places, "c1", known).join(found, ["c1", "c2"]).select("doc", (F.col("pos") + F.col("a")).alias("a"), (F.col("pos") + F.col("b")).alias("b"))
        return merged(cut(located, "located"))  # written, as its runs may be merged before it is read

    def spans(self, texts: DataFrame, since: int = 0) -> DataFrame:
        """Shared stretches (doc, span_start, span_end) of the indexed texts: what ``found`` finds, where it stands."""
        return self.located(self.found(texts, since))


def merged(stretches: DataFrame) -> DataFrame:
    """Maximal runs (doc, span_start, span_end) of stretches (doc, a, b) that overlap or touch."""
    order = Window.partitionBy("doc").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = stretches.withColumn("new", F.when(F.col("a") <= before, 0).otherwise(1))
    numbered = marked.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("doc", "run").agg(F.min("a").cast("int").alias("span_start"), F.max("b").cast("int").alias("span_end")).drop("run")


def shared_share(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """For each row of documents (doc, text): n_spans, shared_chars and the share of its text that they make up (0 for an empty text)."""
    sums = spans.groupBy("doc").agg(F.count("*").alias("n_spans"), F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    length: Column = F.coalesce(F.length("text"), F.lit(0))
    out = documents.select("doc", length.alias("n")).join(sums, "doc", "left")
    chars = F.coalesce("shared_chars", F.lit(0))
    return out.select("doc", F.coalesce("n_spans", F.lit(0)).alias("n_spans"), chars.alias("shared_chars"), F.when(F.col("n") > 0, chars / F.col("n")).otherwise(F.lit(0.0)).alias("share"))
