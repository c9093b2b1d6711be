"""Lines repeated across the documents of one source.

Method: for each source the line identifiers of its documents are concatenated, with a mark of its
own after every document; a suffix array and its common prefixes give the blocks of lines that stand
in many documents.  A source is cut into chunks of documents so that no task holds a whole source: a
block that spans more than a share of the documents spans more than that share of at least one
chunk, so the blocks found by the chunks' suffix arrays are all that can qualify.  The candidates'
documents are then counted exactly over the whole source with map-side combination.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.arrow import groups, spread
from millrace.scratch import cut
from millrace.text import body_of

LINK = re.compile(r"https?://\S*")
WORD = re.compile(r"[^\W\d_]+")
#: Lines shorter than this, trimmed, are never taken out.
LEAST_CHARS = 30
#: Share of a source's documents that a block must exceed, and the fewest documents of a source.
SHARE, LEAST_DOCUMENTS = 0.4, 5
#: Documents of one source whose lines one suffix array holds, about.
CHUNK = 4000

_PLAIN = re.compile(r"[a-z]+")


def line_key(line: str) -> int | None:
    """A 64-bit id of a line's lower-cased words without links; None for a line that doesn't count."""
    line = line.strip()
    if len(line) < LEAST_CHARS:
        return None
    low = line.lower()
    if "http" in low:
        low = LINK.sub(" ", low)
    words = (_PLAIN if low.isascii() else WORD).findall(low)
    if not words:
        return None
    return xxhash.xxh3_64_intdigest(" ".join(words)) - (1 << 63)


def _lines_of(batches: Iterator[pa.RecordBatch], whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Line ids of texts; with ``whole`` their texts too, and rows without line ids (null) for blank ones."""
    known: dict[str, int | None] = {}
    for batch in batches:
        ids, keys, numbers = [], [], []
        at = []
        for row, (i, text) in enumerate(zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())):
            if i is None or text is None or not text.strip():
                if whole and i is not None:
                    at.append(row)
                    ids.append(i)
                    keys.append(None)
                    numbers.append(None)
                continue
            own, where = [], []
            for no, line in enumerate(text.split("\n")):
                if len(line) < LEAST_CHARS:
                    continue
                if line in known:
                    key = known[line]
                else:
                    if len(known) > 50_000:
                        known.clear()
                    key = known[line] = line_key(line)
                if key is not None:
                    own.append(key)
                    where.append(no)
            at.append(row)
            ids.append(i)
            keys.append(own)
            numbers.append(where)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.string()),
                batch.column("source").take(pa.array(at, pa.int64())),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(numbers, pa.list_(pa.int32())),
                *([batch.column("text").take(pa.array(at, pa.int64()))] if whole else []),
            ],
            names=["id", "source", "keys", "line_nos", *(["text"] if whole else [])],
        )


def _body_lines(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("source"), pa.array([body_of(x) for x in b.column("raw_json").to_pylist()], pa.string())], names=["id", "source", "text"])

        yield from _lines_of(texts(), whole)

    return run


LINES = "id string, source string, keys array<bigint>, line_nos array<int>"


def suffix_array(x: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of x's suffixes by their first values, and the common prefix of each with the one before.

    Prefix doubling up to 2**k >= longest; longer common prefixes cannot occur, since every
    document ends with a value of its own.  x isn't empty.
    """
    n = len(x)
    rank = np.unique(x, return_inverse=True)[1].astype(np.int64)
    ranks, step = [rank], 1
    while step < min(longest, n):
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank)
        step *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[1:].copy(), order[:-1].copy()
    common = np.zeros(n - 1 if n else 0, np.int64)
    for k in range(len(ranks) - 2, -1, -1):  # at the top all ranks differ
        size = 1 << k
        inside = (a < n) & (b < n)
        same = inside & (ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)])
        common[same] += size
        a[same] += size
        b[same] += size
    return order, np.concatenate([[0], common])


def repeated_blocks(documents: list[np.ndarray], share: float) -> list[tuple[tuple[int, ...], int]]:
    """Blocks of consecutive lines in more than ``share`` of the documents that no longer block of as many documents holds.

    Returns (line keys, number of documents); found on the suffix array of all lines.
    """
    total = len(documents)
    longest = max((len(d) for d in documents), default=0) + 1
    flat = np.concatenate([*documents, np.zeros(0, np.int64)])
    if not len(flat):
        return []
    values, dense = np.unique(flat, return_inverse=True)
    lengths = np.array([len(d) for d in documents])
    ends = np.cumsum(lengths + 1) - 1
    x = np.zeros(len(flat) + total, np.int64)
    mark = np.zeros(len(x), bool)
    mark[ends] = True
    x[~mark] = dense
    x[mark] = len(values) + np.arange(total)
    owner = np.repeat(np.arange(total), lengths + 1)
    order, common = suffix_array(x, 2 * longest)
    out: dict[tuple[int, ...], int] = {}
    size = 1
    # suffixes, by their place in the order, that begin a block of this size in often enough documents so far
    left = np.flatnonzero(~mark[order])
    while len(left):
        # a block that begins one line before a document's end mark, or reaches over it, is none
        inside = order[left] + size <= ends[owner[order[left]]]
        left = left[inside]
        if not len(left):
            break
        new = np.concatenate([[True], (np.diff(left) != 1) | (common[left[1:]] < size)])
        run = np.cumsum(new) - 1
        pairs = np.unique(run * total + owner[order[left]])
        in_documents = np.bincount(pairs // total, minlength=run[-1] + 1)
        often = in_documents > share * total
        for at, many in zip(order[left[np.flatnonzero(new)[often]]].tolist(), in_documents[often].tolist()):
            block = tuple(values[x[at : at + size]].tolist())
            for part in (block[1:], block[:-1]):
                if out.get(part) == many:
                    del out[part]
            out[block] = many
        left = left[often[run]]
        size += 1
    return sorted(out.items())


def _chunk_blocks(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["source", "chunk"]):
            documents = [np.asarray(v, np.int64) for v in t.column("keys").to_pylist()]
            found = repeated_blocks(documents, share)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([t.column("source")[0].as_py()] * len(found), pa.string()), pa.array([list(b) for b, _ in found], pa.list_(pa.int64()))], names=["source", "block"])

    return run


def posting_lines(jobs: DataFrame, whole: bool = False) -> DataFrame:
    """Line ids of the bodies of postings: one row for each id with a body that isn't blank.

    whole: with the bodies as ``text``, and a row with null line ids for each id whose body is blank.

    jobs: id, ats, board_token, raw_json; other columns are ignored, whatever their names.  Rows
    without id are left out, repeated rows of one id count once, a null source is a source of its own.
    """
    source = F.to_json(F.struct("ats", "board_token"))
    read = spread(jobs.select("id", source.alias("source"), "raw_json")).mapInArrow(_body_lines(whole), LINES + (", text string" if whole else ""))
    return read.dropDuplicates(["id"])


def text_lines(documents: DataFrame, id_column: str, source_column: str, text_column: str) -> DataFrame:
    """Line ids of plain texts, in the form that ``repeated_lines`` takes."""
    read = spread(documents.select(F.col(id_column).cast("string").alias("id"), F.col(source_column).cast("string").alias("source"), F.col(text_column).alias("text"))).mapInArrow(_lines_of, LINES)
    return read.dropDuplicates(["id"])


#: Rows, one a source, that are sent to the workers at most; more are joined.
MOST_SOURCES = 20_000


def _with_source(lines: DataFrame, facts: DataFrame, how: str = "inner") -> DataFrame:
    """lines with what is known of their source. Sent to the workers where the sources are few, so a large one's lines stay spread."""
    facts = facts.withColumnRenamed("source", "_source")
    facts = F.broadcast(facts) if facts.count() <= MOST_SOURCES else facts
    return lines.join(facts, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _chunks(lines: DataFrame, chunk: int, least: int) -> DataFrame:
    sizes = cut(lines.groupBy("source").agg(F.count("*").alias("n")).filter(F.col("n") >= least), "sizes")
    return _with_source(lines, sizes).withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / chunk)))


def frequent_blocks(lines: DataFrame, share: float = SHARE, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """Candidate blocks (source, block array<bigint>): frequent in at least one chunk of the source."""
    return _candidates(_chunks(lines, chunk, least), share)


def _candidates(chunks: DataFrame, share: float) -> DataFrame:
    parts = chunks.select("source", "chunk", "id", "keys").repartition("source", "chunk").sortWithinPartitions("source", "chunk", "id")
    return parts.mapInArrow(_chunk_blocks(share), "source string, block array<bigint>").distinct()


def _parts_counted(key, chunk: pa.Table, blocks: pa.Table) -> pa.Table:
    """In how many of a chunk's documents every block stands, and every part of a block that stands in one."""
    parts = {b[i:j] for b in map(tuple, blocks.column("block").to_pylist()) for i in range(len(b)) for j in range(i + 1, len(b) + 1)}
    many: Counter[tuple[int, ...]] = Counter()
    for keys in map(tuple, chunk.column("keys").to_pylist()):
        seen = set()
        for i in range(len(keys)):
            for j in range(i + 1, len(keys) + 1):  # the beginning of a part is a part
                if keys[i:j] not in parts:
                    break
                seen.add(keys[i:j])
        many.update(seen)
    return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(many), pa.string()), pa.array([list(b) for b in many], pa.list_(pa.int64())), pa.array(list(many.values()), pa.int64())], names=["source", "block", "many"])


def counted_blocks(lines: DataFrame, share: float = SHARE, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """Blocks (source, block array<bigint>) in more than ``share`` of the source's documents that no longer block of as many documents holds.

    lines: written ones, since they are read several times.  A source of one chunk has its blocks from its suffix array.  Of others the chunks' blocks and all their parts are
    counted in every chunk: a block that no longer one holds in the source may be held by one in each of the chunks.
    """
    chunks = _chunks(lines, chunk, least)
    candidates = cut(_candidates(chunks, share), "blocks")
    sizes = chunks.select(F.col("source").alias("s"), "n").distinct()
    known = candidates.join(sizes, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = known.filter(F.col("n") > chunk).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n") / chunk) - 1)))
    held = chunks.filter(F.col("n") > chunk).select("source", "chunk", "keys").groupBy("source", "chunk").cogroup(dealt.groupBy("source", "chunk"))
    counts = held.applyInArrow(_parts_counted, "source string, block array<bigint>, many bigint").groupBy("source", "block").agg(F.sum("many").alias("many"))
    often = cut(counts.join(sizes, F.col("source").eqNullSafe(F.col("s"))).filter(F.col("many") > F.lit(share) * F.col("n")).select("source", "block", "many"), "counted")
    shorter = F.array(F.slice("block", F.lit(2), F.size("block") - 1), F.slice("block", F.lit(1), F.size("block") - 1))
    inner = often.filter(F.size("block") > 1).select(F.col("source").alias("s"), F.explode(shorter).alias("b"), F.col("many").alias("m")).distinct()
    whole = often.join(inner, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")) & (F.col("many") == F.col("m")), "left_anti")
    return known.filter(F.col("n") <= chunk).select("source", "block").unionByName(whole.select("source", "block"))


def with_hits(lines: DataFrame, share: float = SHARE, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """Written lines (see ``posting_lines``) and ``gone``: the numbers of those in blocks to delete (null or empty for none).

    A line that stands in more than ``share`` of the documents is in a block of as many, if only of itself, and every line of
    a block stands in at least as many documents as the block: the blocks decide.  A source has 1 / share times as many such lines
    as its documents have on average, at most, so its list is short.
    """
    known = lines.filter("keys is not null").select("id", "source", "keys", "line_nos")
    blocks = counted_blocks(known, share, least, chunk)
    chosen = cut(blocks.select("source", F.explode("block").alias("key")).groupBy("source").agg(F.collect_set("key").alias("chosen")), "chosen")
    gone = F.transform(F.filter(F.arrays_zip("keys", "line_nos"), lambda x: F.array_contains("chosen", x["keys"])), lambda x: x["line_nos"])
    return _with_source(lines, chosen, "left").withColumn("gone", gone).drop("chosen")


def repeated_lines(lines: DataFrame, share: float = SHARE, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """Lines to take out: rows (id, line_no) of ``lines`` that belong to a block in more than ``share`` of the source's documents.

    Sources with fewer than ``least`` documents yield none; an empty table yields no row.
    """
    return with_hits(cut(lines, "lines"), share, least, chunk).select("id", F.explode("gone").alias("line_no"))


def cleaned(lines: DataFrame, share: float = SHARE, least: int = LEAST_DOCUMENTS, chunk: int = CHUNK) -> DataFrame:
    """Texts without their repeated lines: id, text, lines_removed.

    lines: as ``posting_lines(whole=True)`` gives them; the texts cross the network once, to keep one row for each id.
    """
    hit = with_hits(cut(lines, "lines"), share, least, chunk)
    return hit.select("id", _without("text", "gone").alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("lines_removed"))


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, numbers: pd.Series) -> pd.Series:
    out = []
    for text, drop in zip(texts, numbers):
        if drop is None or not len(drop):
            out.append(text)
        else:
            gone = set(drop)
            out.append("\n".join(line for no, line in enumerate(text.split("\n")) if no not in gone))
    return pd.Series(out)


def without_lines(texts: DataFrame, removed: DataFrame) -> DataFrame:
    """texts (id, text) without the lines of ``removed`` (id, line_no): id, text, lines_removed."""
    lists = removed.groupBy("id").agg(F.collect_list("line_no").alias("gone"))
    return texts.join(lists, "id", "left").select("id", _without("text", "gone").alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("lines_removed"))
