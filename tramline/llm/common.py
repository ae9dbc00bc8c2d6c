"""Shared helpers: shared-folder tables, words and their hashes, bounded text chunks."""
from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir

#: A word: a run of characters other than ASCII white space (Java, RE2 and Python read it alike).
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy step works on; memory follows this, not the batch or the table.
CHUNK_BYTES = 1 << 20
#: Rows of one Arrow batch, at most: what a task holds of a table with texts of usual length.
BATCH_ROWS = 2000
#: Sides of at most this many fixed-width bytes may be broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write df under the shared checkpoint folder and read it back: cuts the lineage, survives lost executors,
    and gives Spark the table's true size for its join choices."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}/{what}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Prepares a session for this package's Python tasks: lowers the rows of an Arrow batch to BATCH_ROWS (texts are
    wider than the default assumes) and sends the package's code to the executors, as ``--py-files`` would."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='tramline-code-')}/{package.name}_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint only for a counted, fixed-width side within BROADCAST_BYTES; otherwise Spark shuffles."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def n_words(text) -> F.col:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(column: str, modulus: int):
    """crc32(doc_id as text) mod modulus; NULL for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# ------------------------------------------------------------------ numpy side
_rng = np.random.Generator(np.random.PCG64(20240501))
_R = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All ASCII but letters and digits.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and the n + 1 offsets into them."""
    arr = pc.fill_null(texts.cast(pa.large_string()), "")
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    if arr.buffers()[2] is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(arr.buffers()[2], np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offs = flat(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words of a slice of texts: (lower-cased) bytes, start, end, row and 64-bit hash of each word.

    between: which bytes separate words."""

    def __init__(self, texts: pa.Array, lower: bool = True, between: np.ndarray = _SPACE):
        self.raw, self.offs = flat(texts)
        self.rows = len(texts)
        self.low = _LOWER[self.raw] if lower else self.raw
        inside = ~between[self.low]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = self.offs[:-1] < self.offs[1:]
        begin, end = self.offs[:-1][full], self.offs[1:][full] - 1
        first[begin] = inside[begin]
        last[end] = inside[end]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.offs, self.starts, side="right") - 1
        self.count = np.bincount(self.row, minlength=self.rows).astype(np.int64)
        self.inside = inside

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        size = self.ends - self.starts
        at = np.flatnonzero(self.inside)
        head = np.cumsum(size) - size
        pos = np.minimum(np.arange(len(at)) - np.repeat(head, size), 63)
        with np.errstate(over="ignore"):
            h = np.add.reduceat((self.low[at].astype(np.uint64) + np.uint64(1)) * _R[pos], head)
        for k in np.flatnonzero(size > 64):
            h[k] = xxhash.xxh64_intdigest(self.low[self.starts[k]:self.ends[k]].tobytes())
        return mix64(h)

    def word(self, k: int) -> bytes:
        return self.low[self.starts[k]:self.ends[k]].tobytes()


def windows(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of n words within a row, and the index of the window's first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[n - 1:] == row[:len(row) - n + 1])
    with np.errstate(over="ignore"):
        s = np.full(len(at), n, np.uint64)
        for k in range(n):
            s += h[at + k] * _R[k]
    return mix64(s), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def arrow_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def sorted_sum(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the values of each distinct key."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    k, v = keys[order], values[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[head], np.add.reduceat(v, head)


def row_hashes(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each row that has words, over all its words in order (rows of up to 64 words), and the rows."""
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(head, len(row)))
    with np.errstate(over="ignore"):
        s = np.add.reduceat(h * _R[np.arange(len(row)) - np.repeat(head, size)], head) + size.astype(np.uint64)
    return mix64(s), row[head]


def same_type(df: DataFrame, column: str):
    """Arrow type of a column as Spark hands it to Python."""
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[column].dataType)
