"""Helpers shared by the operators of this subpackage.

Word model used by every operator that looks at words: a text is lower-cased
and a word is a maximal run of ASCII letters, digits and non-ASCII characters.
``word_table`` turns the UTF-8 buffer of a whole Arrow column into word hashes
with vectorised numpy, in pieces of bounded size, so a very long text costs
no more memory per byte than a short one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import scratch_path

PIECE = 1 << 21  # bytes of text hashed at once

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[ord("0"):ord("9") + 1] = True
_IS_WORD[ord("a"):ord("z") + 1] = True
_IS_WORD[ord("A"):ord("Z") + 1] = True
_IS_WORD[128:] = True

_POS = 512
_WEIGHT = (np.random.default_rng(20_011).integers(1, 1 << 63, size=_POS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser (bijective), in place on uint64."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes of all rows and the row offsets (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    arr = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    lo, hi = (int(o[0]), int(o[-1])) if len(o) else (0, 0)
    raw = np.frombuffer(data, dtype=np.uint8)[lo:hi] if data is not None else np.zeros(0, np.uint8)
    return raw, o - lo


def word_table(raw: np.ndarray, offsets: np.ndarray, head: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each row the index of its first word.

    Second result has one entry more than there are rows. With ``head``, only
    the first bytes of each word count.
    """
    n, hashes, firsts = len(raw), [], np.zeros(len(offsets), np.int64)
    starts_seen, row_lo, lo = 0, 0, 0
    while lo < n:
        hi = min(n, lo + PIECE)
        # a piece ends at a row end or where a word ends, so no word is cut
        if hi < n and _IS_WORD[raw[hi]] and _IS_WORD[raw[hi - 1]]:
            back = np.flatnonzero(~_IS_WORD[raw[lo:hi]])
            row = offsets[np.searchsorted(offsets, hi, side="right") - 1]
            cut = max(int(row), lo + (int(back[-1]) + 1 if len(back) else 0))
            if cut > lo:
                hi = cut
            else:  # one word longer than a piece: go on to its end
                ahead = np.flatnonzero(~_IS_WORD[raw[hi:]])
                nxt = offsets[min(np.searchsorted(offsets, hi, side="left"), len(offsets) - 1)]
                hi = min(hi + int(ahead[0]) if len(ahead) else n, int(nxt) if nxt > lo else n)
        b = raw[lo:hi]
        word = _IS_WORD[b]
        start = word.copy()
        start[1:] &= ~word[:-1]
        r0, r1 = np.searchsorted(offsets, lo, "left"), np.searchsorted(offsets, hi, "left")
        inner = offsets[r0:r1] - lo  # rows that begin in this piece
        start[inner] = word[inner]
        at = np.flatnonzero(start).astype(np.int32)
        if len(at):
            idx = np.flatnonzero(word).astype(np.int32)
            first = np.searchsorted(idx, at)
            per = np.diff(np.append(first, len(idx)))
            pos = np.arange(len(idx), dtype=np.int32) - np.repeat(first, per).astype(np.int32)
            if head:
                idx, pos = idx[pos < head], pos[pos < head]
                per = np.minimum(per, head)
                first = np.concatenate(([0], np.cumsum(per)[:-1]))
            long = pos >= _POS
            if long.any():
                pos = np.where(long, pos % _POS, pos)
            h = np.add.reduceat(_WEIGHT[pos] * (b[idx].astype(np.uint64) + np.uint64(1)), first)
            h += per.astype(np.uint64)
            hashes.append(mix64(h))
        firsts[r0:r1] = starts_seen + np.searchsorted(at, inner)
        starts_seen += len(at)
        lo = hi
    firsts[np.searchsorted(offsets, n, "left"):] = starts_seen
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), firsts


def word_hash(word: str) -> int:
    """Hash of one word, as ``word_table`` gives it."""
    raw = np.frombuffer(word.lower().encode(), np.uint8)
    h, _ = word_table(raw, np.array([0, len(raw)], np.int64))
    return int(h[0])


def row_slices(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``most`` bytes of text each.
    Memory that Arrow no longer uses goes back after each batch."""
    col = batch.column(column)
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo, total = 0, 0
    for i, s in enumerate(size):
        if i > lo and total + s > most:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += int(s)
    if lo < batch.num_rows:
        yield batch.slice(lo)
    pa.default_memory_pool().release_unused()


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Exactly the named columns under new names, so no other column of the
    input (also one of the same name as an output) can clash: ``only(d, id="doc_id")``.
    """
    return df.select([F.col(f"`{src}`").alias(name) for name, src in columns.items()])


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder (see ``spark.checkpoint.dir``)
    and read again: computed once, and not lost with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BLOOM_BITS, BLOOM_HASHES = 1 << 27, 4   # at most 16 MB


def bloom_bits(h: np.ndarray, size: int) -> np.ndarray:
    """Places of 64-bit hashes in a filter of ``size`` bits, one row for each hash."""
    h = h.view(np.uint64)
    step = mix64(h.copy()) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) % np.uint64(size) for k in range(BLOOM_HASHES)], axis=1)


def bloom(hashes: DataFrame, column: str, expected: int) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, as packed bits. Its size follows
    ``expected`` up to BLOOM_BITS, and so bounds what reaches the driver; beyond
    that it lets more through, and never holds anything back that is there."""
    size = max(1024, min(BLOOM_BITS, 1 << (16 * max(expected, 1)).bit_length()))

    def run(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.unique(bloom_bits(h, size))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(bit, cut) if len(cut) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(word[cut]), pa.array(bits.view(np.int64))], names=["word", "bits"])

    out = np.zeros(size // 64, np.uint64)
    got = hashes.select(column).mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def in_bloom(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = bloom_bits(h, len(bits) * 64)
    return ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
