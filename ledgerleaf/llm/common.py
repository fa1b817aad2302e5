"""What the operators share: staging in the shared folder, row buckets, byte blocks and word arithmetic."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf.session import shared_dir

#: Words are runs of anything but these six bytes.
WORD = r"[^\x20\x09-\x0D]+"
SOLID = np.ones(256, dtype=bool)
SOLID[list(b" \t\n\x0b\x0c\r")] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written to the folder that ``spark.checkpoint.dir`` names, and read back.

    Lost executors then cost at most the stage that runs.  Only where the setting is missing,
    as in tests, the session's warehouse folder is used.
    """
    spark = df.sparkSession
    root = shared_dir(spark, spark.conf.get("spark.sql.warehouse.dir"))
    path = f"{root}/llm/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def id_type(docs: DataFrame, name: str = "doc_id") -> str:
    return docs.schema[name].dataType.simpleString()


def crc_bucket(name: str = "doc_id", buckets: int = 5) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % buckets


# ---- byte blocks -------------------------------------------------------------------------


def pieces(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of a piece stay under ``limit`` bytes, or are a single text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte vector, and the offsets between them.  The texts must not be null."""
    texts = texts.cast(pa.large_string()) if pa.types.is_string(texts.type) else texts
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; bytes of equal weight lie together, which small numbers compress well in."""
    head = json.dumps([[a.dtype.str, len(a)] for a in arrays]).encode()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(len(head).to_bytes(4, "little") + head + b"".join(planes))


def unpack(body: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    at = 4 + int.from_bytes(raw[:4], "little")
    arrays = []
    for kind, n in json.loads(raw[4:at]):
        size = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, dtype=np.uint8, count=n * size, offset=at)
        arrays.append(np.ascontiguousarray(plane.reshape(size, n).T).reshape(-1).view(kind))
        at += n * size
    return arrays


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer keys, from rows that arrive sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


# ---- words and shingles ------------------------------------------------------------------


def words(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of every word, the byte after its last, and the number of words of each text."""
    solid = SOLID[buffer]
    full = offsets[:-1] < offsets[1:]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begins[first], ends[last] = solid[first], solid[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return starts, stops, counts


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalising bit mix of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.cumprod(out, dtype=U64)


def word_hashes(buffer: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words as they stand in ``buffer``."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    lengths = stops - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    values = (buffer[place + np.repeat(starts, lengths)].astype(U64) + U64(1)) * powers(0x9E3779B97F4A7C15, int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, at) + lengths.astype(U64))


def shingle_hashes(buffer: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``width`` lower-cased words, and how many each text has.

    A text of fewer words has one shingle, all of them; a text without words has none.
    """
    low = LOWER[buffer]
    starts, stops, counts = words(low, offsets)
    hashes = word_hashes(low, starts, stops)
    room = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))
    begins = np.zeros(len(hashes), dtype=bool)
    begins[(np.cumsum(counts) - counts)[counts > 0]] = True
    value = hashes.copy()
    factors = powers(0xD1342543DE82EF95, width)
    for k in range(1, width):
        follows = np.flatnonzero(room > k)
        value[follows] += hashes[follows + k] * factors[k]
    keep = (room >= width) | (begins & (np.repeat(counts, counts) < width))
    return mixed(value[keep]), np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
