"""Trimming of read pairs: ends of low quality, adapters at the 3' end, fixed clips; mates stay together.

Qualities: from the 3' end on, the differences of a threshold and the qualities are summed; the read is
cut where the sum is largest, and summing stops where it falls below zero.

Adapters are matched with errors. Of every end of a stretch of the read the stretch is taken that the
adapter differs least from (bases replaced, missing or more; of equally good ones the longest), if it has
at most error_rate times the adapter's length of errors; at the read's end also those that the first bases
of the adapter, `overlap` at least, differ from so little. The read is cut where the first such stretch
begins. Reads that hold no part of the adapter that such a stretch must have are passed over; distances of
all others of a batch are one table that is filled base by base.

Defined results: a null read is empty; a read without qualities (null, or of another length) is not cut by
quality; bases other than the adapter's, N too, are errors; no adapter, or an empty one, cuts nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reads whose distances are one table.
AT_ONCE = 2048
CLASSES = ("filtered_too_short_after_trimming", "passed_trimming")


def bytes_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of bytes, zeros behind their ends, and their lengths."""
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    out = np.zeros((len(raw), int(sizes.max(initial=0))), dtype=np.uint8)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return out, sizes


def quality_ends(qualities: list[str], threshold: int) -> np.ndarray:
    """Where each read is cut for its qualities (characters from 33 on)."""
    table, sizes = bytes_table(qualities)
    total, most, end = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), sizes.copy()
    going = np.ones(len(sizes), dtype=bool)
    for back in range(1, table.shape[1] + 1):
        at = sizes - back
        going &= at >= 0
        if not going.any():
            break
        total += np.where(going, threshold + 33 - table[np.arange(len(sizes)), np.maximum(at, 0)].astype(np.int64), 0)
        going &= total >= 0
        better = going & (total > most)
        most, end = np.where(better, total, most), np.where(better, at, end)
    return end


def adapter_ends(reads: list[str], adapter: str, overlap: int, error_rate: float) -> np.ndarray:
    """Where the first stretch of each read begins that the adapter matches; its length if none does."""
    raw = [r.encode() for r in reads]
    out = np.array([len(r) for r in raw], dtype=np.int64)
    some = possible(raw, adapter.encode(), overlap, error_rate) if adapter else []
    if some:
        out[some] = _searched([reads[k] for k in some], adapter, overlap, error_rate)
    return out


def possible(reads: list[bytes], adapter: bytes, overlap: int, error_rate: float) -> list[int]:
    """The reads that a stretch may match in: of n + 1 parts of what is matched with n errors at most, one is there without any."""
    m = len(adapter)

    def parts(k: int) -> set[bytes]:
        n = int(error_rate * k) + 1
        return {adapter[k * j // n : k * (j + 1) // n] for j in range(n)}

    ends = range(min(overlap, m), m)
    exact = tuple(adapter[:k] for k in ends if int(error_rate * k) == 0)
    last = [(k + int(error_rate * k), tuple(parts(k))) for k in ends if int(error_rate * k)]
    anywhere = tuple(parts(m))
    return [i for i, r in enumerate(reads) if r.endswith(exact) or any(p in r for p in anywhere) or any(p in r[-size:] for size, own in last for p in own)]


def _searched(reads: list[str], adapter: str, overlap: int, error_rate: float) -> np.ndarray:
    table, sizes = bytes_table(reads)
    own = np.frombuffer(adapter.encode(), dtype=np.uint8)
    m, out = len(own), sizes.copy()
    allowed = [int(error_rate * k) for k in range(m + 1)]
    # a cell holds the errors and, below them, where the stretch begins: the least is the best
    error = np.int64(1) << 32
    before = np.repeat(np.arange(m + 1, dtype=np.int64)[:, None] * error, len(sizes), axis=1)
    for end in range(table.shape[1] + 1):
        if end:
            now = np.empty_like(before)
            now[0] = end
            for k in range(1, m + 1):
                same = before[k - 1] + np.where(table[:, end - 1] == own[k - 1], 0, error)
                now[k] = np.minimum(same, np.minimum(before[k], now[k - 1]) + error)
            before = now
        here, last = sizes >= end, sizes == end
        for k in [*range(min(overlap, m), m), m]:
            fits = (here if k == m else last) & (before[k] >> 32 <= allowed[k])
            out = np.where(fits, np.minimum(out, before[k] & (error - 1)), out)
    return out


@dataclass(frozen=True)
class Trim:
    """How a mate is trimmed."""

    adapter: str = ""
    quality: int = 20
    overlap: int = 3
    error_rate: float = 0.1
    clip: int = 0


def cut(sequence: Column, qualities: Column, how: Trim) -> Column:
    """How many bases of each read are left."""

    @F.pandas_udf("int")
    def left(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for reads, marks in parts:
            out = []
            for k in range(0, len(reads), AT_ONCE):
                own = [r or "" for r in reads.iloc[k : k + AT_ONCE]]
                given = [q if q is not None and len(q) == len(r) else "~" * len(r) for q, r in zip(marks.iloc[k : k + AT_ONCE], own, strict=True)]
                ends = quality_ends(given, how.quality)
                own = [r[:n] for r, n in zip(own, ends.tolist(), strict=True)]
                out.append(np.maximum(0, adapter_ends(own, how.adapter, how.overlap, how.error_rate) - how.clip))
            yield pd.Series(np.concatenate([np.empty(0, dtype=np.int64), *out]).astype(np.int32))

    return left(sequence, qualities)


def trimmed(pairs: DataFrame, first: Trim, second: Trim, least: int = 20) -> DataFrame:
    """pairs (r1 and r2 with seq and qual, and any other columns) with both mates trimmed, and read_class: whether both have `least` bases left.

    Mates are columns of one row, so they stay in step whatever happens to either.
    """
    rows = pairs.withColumns({"n1": cut(F.col("r1.seq"), F.col("r1.qual"), first), "n2": cut(F.col("r2.seq"), F.col("r2.qual"), second)})
    mates = {f"r{k}": F.col(f"r{k}").withField("seq", F.substr(f"r{k}.seq", F.lit(1), f"n{k}")).withField("qual", F.substr(f"r{k}.qual", F.lit(1), f"n{k}")) for k in (1, 2)}
    read_class = F.when((F.col("n1") >= least) & (F.col("n2") >= least), CLASSES[1]).otherwise(CLASSES[0])
    return rows.withColumns({**mates, "read_class": read_class}).drop("n1", "n2")
