"""Column expressions on read sequences; all but the search with mismatches stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the chemistry.
ADAPTER = "CTGTCTCTTATACACAT"
CONSTANT_1 = "CAAGTTGATA"
CONSTANT_2 = "ATCTTGTGGA"
BASES = "ACGTN"


def piece(sequence: Column, start: int, end: int) -> Column:
    """Bases [start, end), counted from 0; shorter at the read's end."""
    return F.substring(sequence, start + 1, end - start)


def rest(sequence: Column, start: Column | int) -> Column:
    """Bases from start (counted from 0) on."""
    begin = F.lit(start) if isinstance(start, int) else start
    return F.substr(sequence, begin + 1, F.greatest(F.length(sequence) - begin, F.lit(0)))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGTNacgtn", "TGCANtgcan"))


def poly_t_length(sequence: Column, least: int = 5) -> Column:
    """Length of the leading run of T, if it has at least `least`; otherwise 0."""
    return F.length(F.regexp_extract(sequence, f"^T{{{least},}}", 0))


def before(sequence: Column, other: Column) -> Column:
    """Number of bases before the first occurrence of `other`; all of them if there is none. An empty `other` occurs at once."""
    at = F.instr(sequence, other)
    return F.when(at > 0, at - 1).otherwise(F.length(sequence))


def before_within(sequence: Column, pattern: str, mismatches: int) -> Column:
    """Number of bases before the first occurrence of `pattern` with at most `mismatches` other bases; all of them if there is none.

    The reads of a batch are one row of letters, which is compared with the pattern base by base for all starts
    at once. Occurrences are whole: none goes beyond the read's end.
    """
    size = len(pattern)
    if mismatches <= 0 or not size:
        return before(sequence, F.lit(pattern))
    if set(pattern) - set("ACGTN"):
        raise ValueError(f"a pattern of the bases ACGTN is needed: {pattern!r}")

    @F.pandas_udf("int")
    def first(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            known = part.notna().to_numpy()
            reads = part[known].tolist()
            letters = np.frombuffer("".join(reads).encode("utf-32-le"), dtype=np.uint32)
            lengths = np.fromiter(map(len, reads), dtype=np.int64, count=len(reads))
            starts = np.cumsum(lengths) - lengths
            other = np.zeros(max(len(letters) - size + 1, 0), dtype=np.int32)
            for k, base in enumerate(pattern):
                other += letters[k : k + len(other)] != ord(base)
            places = np.append(np.flatnonzero(other <= mismatches), len(letters))
            at = places[np.searchsorted(places, starts)] - starts
            found = pd.array([None] * len(part), dtype="Int32")
            found[known] = np.where(at <= lengths - size, at, lengths).astype(np.int32)
            yield pd.Series(found)

    return first(sequence)


def variants(sequence: str) -> list[str]:
    """A literal sequence with any one base replaced by any of BASES, itself included, in order."""
    return sorted({sequence[:k] + base + sequence[k + 1 :] for k in range(len(sequence)) for base in BASES})


def within_one(sequence: Column, literal: str) -> Column:
    """Whether a sequence is a literal with at most one base replaced."""
    return F.coalesce(sequence.isin(variants(literal)), F.lit(False))


def cell_of_name(name: Column) -> Column:
    return F.get(F.split(name, ","), F.lit(0))


def umi_of_name(name: Column) -> Column:
    return F.get(F.split(name, ","), F.lit(1))


def composed_name(ligation: Column, rt: Column, umi: Column, original: Column) -> Column:
    """`<ligation><RT>,<UMI>,<original id>`"""
    return F.concat(ligation, rt, F.lit(","), umi, F.lit(","), original)


def header(name: Column, description: Column) -> Column:
    """New id and original description: the description alone if its first word is the id."""
    first = F.get(F.split(description, r"\s+"), F.lit(0))
    return F.when(F.coalesce(description, F.lit("")) == "", name).when(first == name, description).otherwise(F.concat_ws(" ", name, description))
