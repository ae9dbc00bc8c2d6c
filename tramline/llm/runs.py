r"""Periodic runs of words in whole texts, and the texts with each run collapsed to its first period.

A run is a stretch of consecutive words ``[^\x20\x09-\x0D]+`` whose smallest period is q, at least max(LEAST, TIMES * q)
words long, that no neighbouring word extends keeping the period.

Periods are handled by octave, [B, 2B). A text is laid out in overlapping tiles whose width grows with the octave;
inside a tile every B-th word is a boundary. A run of an octave is at least four of its B long, so it holds several
boundaries, and from each of them two Z-functions (forward from the boundary, backward from it) give how far the words
agree with those q further on, up to 2B either way. Such an interval is a fragment of the run; neighbouring boundaries'
fragments of one period meet, so their union is the whole run, whatever tiles it spans. Only boundaries where a hashed
stretch of words comes again at a distance of the octave need the Z-functions (equal words have equal hashes, so none
is missed), and a period that is a multiple of a smaller one is told by the same Z-function.

A text of at most LONG bytes is one tile for all octaves: its fragments are stitched where they are found and nothing
is shuffled. Longer texts are exploded into tiles that are dealt over all tasks, and their fragments are shuffled by
(text, period) and stitched there. A task so holds one tile, never all tiles of a text; equal long texts are solved once.

Defined results: null and empty texts and texts of fewer words than LEAST have no runs; null gives an empty collapsed
text; repeated rows and rows without doc_id give a row each; an empty table gives an empty result; columns named like
the results are replaced, other columns are kept.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, Words, arrow_batch, chunks, mix64, ready, stored

LEAST = 6
TIMES = 4
#: Bytes of a text that is one tile.
LONG = 1 << 16
#: Words of a tile's core at least; a tile of the octave [B, 2B) is SPREAD * B wide where that is more.
CORE = 1 << 15
SPREAD = 16
#: Words that a hashed stretch has at most.
GRAM = 16

RESULTS = ["n_words", "runs", "collapsed"]
_RUNS_DDL = "array<struct<start: bigint, length: bigint, period: bigint>>"


# ------------------------------------------------------------------ one tile
def z_function(s: list) -> list[int]:
    """z[i]: how many items from i on equal those from 0 on."""
    n = len(s)
    z = [n] + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each stretch of ``size`` (a power of two) codes."""
    h, half = mix64(codes.astype(np.uint64)), 1
    with np.errstate(over="ignore"):
        while half < size:
            h = mix64(h[:-half] * np.uint64(0x9E3779B97F4A7C15) + h[half:])
            half *= 2
    return h


def _at_boundary(s: np.ndarray, c: int, b: int) -> list[tuple[int, int, int]]:
    """(period, first, end): stretches around boundary c whose words equal those a period of [b, 2b) further on, no
    farther than 2b from c, and that reach 2b on one side at least; smallest periods only."""
    ahead = z_function(s[c:c + 4 * b].tolist())
    back = s[c - 2 * b:c + 2 * b][::-1].tolist()
    behind = z_function(back[2 * b:] + [None] + back)
    out = []
    for q in range(b, 2 * b):
        f, k = min(ahead[q], 2 * b), min(behind[4 * b + 1 - q], 2 * b)
        if max(f, k) >= 2 * b and not any(ahead[q // p] >= q - q // p for p in prime_factors(q)):
            out.append((q, c - k, c + f))
    return out


def fragments(codes: np.ndarray, octaves: list[int], low: int = 0, high: int | None = None) -> list[tuple[int, int, int]]:
    """(period, first, end) of stretches whose words equal those a period further on, stitched within the tile, sorted.

    codes: the tile with its margins; boundaries lie in [low, high). Their union with those of the other tiles holds
    every run of the octaves from end to end (a run that begins at first is end - first + period words long)."""
    high = len(codes) if high is None else high
    if not octaves or high <= low:
        return []
    margin = 4 * max(octaves)
    pad = -1 - np.arange(2 * margin)  # unlike any word and each other
    s = np.concatenate([pad[:margin], codes, pad[margin:]]).astype(np.int64)
    found, grams = [], {}
    reach = np.zeros(len(s) + 1, np.int64)  # where the stretches of smaller periods end that begin here or before
    for b in octaves:
        g = min(GRAM, 2 * b)
        if g not in grams:
            grams[g] = _grams(s, g)
        h, start, n = grams[g], low + margin, -(-(high - low) // b)
        c = start + b * np.arange(n)
        hit = np.zeros(n, bool)
        for shift in (0, -g):  # the stretch after the boundary, and the one before it
            there = h[start + shift + b:start + shift + b + n * b].reshape(n, b)
            hit |= (there == h[c + shift][:, None]).any(1)
        # all within a stretch of a smaller period, the periods of the octave are multiples of that one
        hit &= np.maximum.accumulate(reach)[c - 2 * b] < c + 4 * b
        new = stitched([piece for at in c[hit].tolist() for piece in _at_boundary(s, at, b)])
        for q, a, e in new:
            reach[a] = max(reach[a], e + q)
        found += new
    return sorted((q, a - margin, e - margin) for q, a, e in found)


def stitched(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[list[int]] = []
    for q, a, e in sorted(pieces):
        if out and out[-1][0] == q and a <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([q, a, e])
    return [tuple(x) for x in out]


def octaves_of(n_words: int) -> list[int]:
    """Octaves that hold a period of which a text of so many words can have a run."""
    out, b = [], 1
    while TIMES * b <= n_words and n_words >= LEAST:
        out.append(b)
        b *= 2
    return out


def runs_of(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) by start, then period."""
    return sorted((a, e - a + q, q) for q, a, e in pieces if e - a + q >= max(LEAST, TIMES * q))


# ------------------------------------------------------------------ texts
def _codes(words: Words) -> np.ndarray:
    """A number for each word: equal words, equal numbers (exact, within the slice)."""
    size = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = np.ascontiguousarray(words.raw[words.inside])
    column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _collapsed(words: Words, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """Texts of the kept words, joined by one space. runs: by row of the slice."""
    keep = np.ones(len(words.starts), bool)
    head = np.concatenate([[0], np.cumsum(words.count)])
    for row, found in runs.items():
        for start, length, period in found:
            keep[head[row] + start + period:head[row] + start + length] = False
    size = (words.ends - words.starts)[keep]
    row = words.row[keep]
    kept = np.bincount(row, minlength=words.rows)
    first = np.zeros(len(size), bool)
    first[(np.cumsum(kept) - kept)[kept > 0]] = True
    # every kept word but a text's first has a space before it
    to = np.cumsum(size + ~first)
    out = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
    step = np.zeros(len(out) + 1, np.int64)
    np.add.at(step, to - size, 1)
    np.add.at(step, to, -1)
    inside = words.inside.copy()
    drop = np.zeros(len(inside) + 1, np.int64)
    np.add.at(drop, words.starts[~keep], 1)
    np.add.at(drop, words.ends[~keep], -1)
    inside &= np.cumsum(drop[:-1]) == 0
    out[np.cumsum(step[:-1]) > 0] = words.raw[inside]
    bytes_of = np.bincount(row, size + ~first, minlength=words.rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(bytes_of)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), words.rows, [None, pa.py_buffer(offsets), pa.py_buffer(out)])


_RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _finished(part: pa.RecordBatch, columns: list[str], words: Words, runs: dict[int, list]) -> pa.RecordBatch:
    as_rows = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(k, ())] for k in range(words.rows)]
    added = [pa.array(words.count), pa.array(as_rows, _RUNS_TYPE), _collapsed(words, runs).cast(pa.string())]
    return pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in columns] + added,
                                      names=columns + RESULTS)


def _solve_texts(columns: list[str]):
    """Texts of one tile each, a slice of them at a time: one tile of all, with a mark between texts."""
    def run(batches):
        for part in chunks(batches):
            words = Words(part.column(part.schema.get_field_index("text")), lower=False)
            n = len(words.starts)
            head = np.concatenate([[0], np.cumsum(words.count)])[:-1]
            codes = np.full(n + words.rows, -1, np.int64)  # one mark after each text, none like another
            codes[np.arange(n) + words.row] = _codes(words)
            begin = head + np.arange(words.rows)
            marks = begin + words.count
            codes[marks] = n + np.arange(words.rows)
            found: dict[int, list] = {}
            longest = int(words.count.max()) if words.rows else 0
            for q, a, e in fragments(codes, octaves_of(longest)):
                row = int(np.searchsorted(begin, a, side="right")) - 1
                found.setdefault(row, []).append((q, a - int(begin[row]), e - int(begin[row])))
            yield _finished(part, columns, words, {k: runs_of(v) for k, v in found.items()})
    return run


def _collapse_texts(columns: list[str]):
    """Texts that come with their runs."""
    def run(batches):
        for part in chunks(batches):
            words = Words(part.column(part.schema.get_field_index("text")), lower=False)
            found = part.column(part.schema.get_field_index("_runs")).to_pylist()
            yield _finished(part, columns, words, {k: [(r["start"], r["length"], r["period"]) for r in v]
                                                   for k, v in enumerate(found) if v})
    return run


# ------------------------------------------------------------------ tiles of long texts
_TILE = pa.schema([("key", pa.string()), ("from_b", pa.int64()), ("to_b", pa.int64()), ("low", pa.int64()),
                   ("offset", pa.int64()), ("n_core", pa.int64()), ("codes", pa.binary())])
_TILE_DDL = "key string, from_b long, to_b long, low long, offset long, n_core long, codes binary"


def bands(n_words: int) -> list[tuple[list[int], int]]:
    """(octaves, words of a tile's core): the low octaves share tiles, each higher one has wider tiles of its own."""
    every = octaves_of(n_words)
    low = [b for b in every if SPREAD * b <= CORE]
    return [(low, CORE)] * bool(low) + [([b], SPREAD * b) for b in every[len(low):]]


def _explode(batches):
    """key, text -> tiles with their margins."""
    for batch in batches:
        for k in range(batch.num_rows):
            words = Words(batch.column(1).slice(k, 1), lower=False)
            codes, key = _codes(words), batch.column(0)[k].as_py()
            for octaves, core in bands(len(codes)):
                for low in range(0, len(codes), core):
                    offset = max(0, low - 4 * octaves[-1])
                    high = min(low + core, len(codes))
                    part = codes[offset:high + 4 * octaves[-1]]
                    yield arrow_batch(_TILE, [key], [octaves[0]], [octaves[-1]], [low], [offset], [high - low],
                                      [part.astype(np.int32).tobytes()])


_FRAGMENT = pa.schema([("key", pa.string()), ("period", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])


def _solve_tiles(batches):
    for batch in batches:
        for key, b, to_b, low, offset, n_core, raw in zip(*[c.to_pylist() for c in batch.columns]):
            octaves = [b << k for k in range((to_b // b).bit_length())]
            at = low - offset
            found = fragments(np.frombuffer(raw, np.int32).astype(np.int64), octaves, at, at + n_core)
            if found:
                q, a, e = (np.array(x, np.int64) for x in zip(*found))
                yield arrow_batch(_FRAGMENT, [key] * len(q), q, a + offset, e + offset)


def stitch(pieces: DataFrame) -> DataFrame:
    """key, period, first, end -> key, runs: overlapping and touching fragments of a (text, period) are one."""
    order = Window.partitionBy("key", "period").orderBy("first", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("first") > reached), 1).otherwise(0)
    islands = pieces.withColumn("opens", opens).withColumn("island", F.sum("opens").over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "period", "island").agg(F.min("first").alias("start"), F.max("end").alias("end")) \
        .withColumn("length", F.col("end") - F.col("start") + F.col("period")) \
        .filter((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))
    # the runs of one text, whose row holds the text as well
    ordered = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    return whole.groupBy("key").agg(F.transform(ordered, lambda r: F.struct(
        r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("_runs"))


def collapse(docs: DataFrame, long_bytes: int = LONG) -> DataFrame:
    """docs (text and any columns) with n_words, runs (by start, then period) and collapsed: the words that no run
    contains beyond its first period, joined by one space."""
    ready(docs.sparkSession)
    docs = docs.drop(*RESULTS)
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + \
        f", n_words bigint, runs {_RUNS_DDL}, collapsed string"
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > long_bytes
    short = docs.filter(~is_long).mapInArrow(_solve_texts(columns), schema)
    keyed = docs.filter(is_long).withColumn("_key", F.sha2("text", 256))
    tiles = keyed.select("_key", "text").dropDuplicates(["_key"]).mapInArrow(_explode, _TILE_DDL)
    pieces = stored(tiles.repartition("key", "from_b", "low").mapInArrow(
        _solve_tiles, "key string, period long, first long, end long"), "fragments")
    found = stitch(pieces).withColumnRenamed("key", "_key")
    long = keyed.join(found, "_key", "left").select(*columns, "_runs").mapInArrow(_collapse_texts(columns), schema)
    return short.unionByName(long)


# ------------------------------------------------------------------ the registered query
def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: where h = crc32(decimal doc_id) ends in 0, the words from a on repeat with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def laid(words):
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
        again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # the lambda's variable holds the words, so that a text is split once however often its words are named
    again = F.transform(F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))), laid)
    return docs.select("doc_id", F.when(chosen, F.get(again, F.lit(0))).otherwise(F.col("text")).alias("text"))


def longest_exponent(runs: str) -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    better = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
                    lambda best, r: F.when(better(r, best), r).otherwise(best))


def digests(collapsed: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))
    best = [F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")]
    milli = F.expr("1000 * _best.length div _best.period").alias("exponent_milli")
    return collapsed.withColumn("_best", longest_exponent("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best, milli,
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
