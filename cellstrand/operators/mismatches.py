"""MD tags from a reference: what a record's bases are aligned to, where they differ."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.functions import alignment as aln
from cellstrand.functions import batches
from cellstrand.sources.fasta import WINDOW

_OPS = re.compile(r"(\d+)([MIDNSHP=X])")


def md_of(cigar: str, sequence: str, reference: str) -> tuple[str, int] | None:
    """MD and NM of a record; `reference` has the bases of its M, =, X and D operations, one after the other. None if they are not as many.

    A base N of either is a mismatch, and = in the record a match.
    """
    out: list[str] = []
    same = at = query = different = 0
    for number, op in _OPS.findall(cigar):
        size = int(number)
        if op in "M=X":
            own, ref = sequence[query : query + size].upper(), reference[at : at + size].upper()
            if len(own) != size or len(ref) != size:
                return None
            for a, b in zip(own, ref, strict=True):
                if (a == b and a != "N") or a == "=":
                    same += 1
                else:
                    out.append(f"{same}{b}")
                    same, different = 0, different + 1
            at, query = at + size, query + size
        elif op == "D":
            ref = reference[at : at + size].upper()
            if len(ref) != size:
                return None
            out.append(f"{same}^{ref}")
            same, different, at = 0, different + size, at + size
        elif op in "IS":
            query += size
            different += size * (op == "I")
    return "".join([*out, str(same)]), different


def md_and_nm(cigar: Column, sequence: Column, reference: Column) -> Column:
    """struct<md, nm>; null where an input is null or the reference ends too early."""

    @F.arrow_udf("struct<md:string,nm:int>")
    def made(cigars: pa.Array, sequences: pa.Array, references: pa.Array) -> pa.Array:
        found = made_of(cigars, sequences, references)
        return pa.StructArray.from_arrays(found, ["md", "nm"])

    return made(cigar, sequence, reference)


def made_of(cigars: pa.Array, sequences: pa.Array, references: pa.Array) -> list[pa.Array]:
    """md_of of a batch: MD and NM."""
    own, ref = batches.Texts(sequences), batches.Texts(references)
    if not (own.ascii and ref.ascii) or any(re.search(r"(?<!\d)0+D", c or "") for c in cigars.unique().to_pylist()):
        texts = (cigars.to_pylist(), sequences.to_pylist(), references.cast(pa.string()).to_pylist())
        rows = [None if None in row else md_of(*row) for row in zip(*texts, strict=True)]
        return [pa.array([r and r[0] for r in rows], pa.string()), pa.array([r and r[1] for r in rows], pa.int32())]
    columns = batches.Columns(cigars, deletions=True)
    fits = own.known & ref.known & ~np.asarray(cigars.is_null()) & (columns.needed <= own.sizes) & (columns.sizes <= ref.sizes)
    texts, numbers = [], []
    for rows in batches.parts(np.flatnonzero(fits), columns.sizes):
        owner, inside, at = columns.of(rows)
        a = batches.UPPER[own.data[own.starts[rows][owner] + np.maximum(columns.query[at], 0)]]
        b = batches.UPPER[ref.data[ref.starts[rows][owner] + inside]]
        gone = columns.gone[at]
        same = (gone == 0) & (((a == b) & (a != ord("N"))) | (a == ord("=")))
        texts.append(batches.strings(*batches.md_texts(owner, len(rows), same, gone, b)))
        numbers.append(np.bincount(owner[~same], minlength=len(rows)) + columns.inserted[rows])
    return [batches.put_back(pa.concat_arrays(texts), fits), batches.put_back(pa.array(np.concatenate(numbers), pa.int32()), fits)]


def blocks_behind(cigar: Column) -> Column:
    """array<struct<start, end>> of the M, =, X and D operations, counted from pos; each distinct CIGAR of a batch is taken apart once."""

    def of(text: str) -> list[dict[str, int]]:
        out, at = [], 0
        for number, op in _OPS.findall(text):
            if op in "M=XD":
                out.append({"start": at, "end": at + int(number)})
            at += int(number) * (op in "MDN=X")
        return out

    @F.arrow_udf("array<struct<start:int,end:int>>")
    def found(cigars: pa.Array) -> pa.Array:
        coded = cigars.dictionary_encode()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([of(c) for c in coded.dictionary.to_pylist()], kind).take(coded.indices)

    # a filter by it may go below a record's dearer columns
    return found(cigar)


def reference_bases(alignments: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(idx, reference): the reference's bases of each record's M, =, X and D operations, one after the other.

    Blocks are cut at the borders of windows and joined by (contig, window); introns are not looked at. A
    place that very many records cover is one window's row against many, which adaptive execution splits.
    """
    kinds = ("M", "=", "X", "D")
    block = F.explode(aln.blocks(F.col("pos"), F.col("cigar"), kinds))
    each = alignments.where(F.col("rname").isNotNull() & (F.col("pos") >= 0)).select("idx", "rname", block.alias("b"))
    cut = each.select("idx", "rname", "b", F.explode(F.sequence(F.floor(F.col("b.start") / window), F.floor((F.col("b.end") - 1) / window))).alias("window"))
    start = F.greatest(F.col("b.start"), (F.col("window") * window).cast("int"))
    end = F.least(F.col("b.end"), ((F.col("window") + 1) * window).cast("int"))
    met = cut.withColumns({"start": start, "size": end - start}).join(windows, ["rname", "window"])
    piece = F.struct("start", F.substr("bases", (F.col("start") - F.col("window") * window + 1).cast("int"), "size").alias("bases"))
    # as many pieces as the record has operations, and borders of windows in them
    pieces = met.select("idx", piece.alias("piece")).groupBy("idx").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return pieces.select("idx", F.array_join("pieces.bases", "").alias("reference"))


def with_md(alignments: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """alignments (idx identifies a record) with tags MD and NM made anew, of the types Z and i.

    Records without a place, a CIGAR or bases, of contigs that the reference does not have, or beyond its end
    keep their tags as they are. Records that end before the window behind their first one ends, nearly all, meet
    their reference in one join with windows that reach over the next; only others are cut into pieces and put together by idx.
    """
    mapped = (F.col("cigar") != "*") & (F.col("seq") != "*")
    rows = alignments.withColumns({"mapped_": mapped, "blocks_": blocks_behind(F.col("cigar")), "window_": F.floor(F.col("pos") / window)})
    begin = (F.col("pos") - F.col("window_") * window).cast("int")
    near = F.col("rname").isNotNull() & (F.col("pos") >= 0) & (F.size("blocks_") > 0) & (begin + F.element_at("blocks_.end", -1) <= 2 * window)
    near = F.coalesce(near, F.lit(False))
    parts = F.explode(F.array(*[F.struct((F.col("window") - k).alias("window"), F.lit(k).alias("k")) for k in (0, 1)]))
    text = F.col("bases").cast("binary")
    wide = windows.select("rname", "bases", parts.alias("p")).groupBy("rname", F.col("p.window").alias("window_")).agg(*[F.max(F.when(F.col("p.k") == k, text)).alias(f"bases{k}_") for k in (0, 1)])
    wide = wide.where("bases0_ is not null").select("rname", "window_", F.concat("bases0_", F.coalesce("bases1_", F.lit("").cast("binary"))).alias("bases_"))
    pieces = F.transform("blocks_", lambda b: F.substr("bases_", begin + b["start"] + 1, b["end"] - b["start"]).cast("string"))
    local = rows.where(near).join(wide, ["rname", "window_"], "left").withColumn("reference", F.when(F.col("bases_").isNotNull(), F.array_join(pieces, "")))
    far = rows.where(~near)
    far = far.join(reference_bases(far, windows, window), "idx", "left")
    kept = [*alignments.columns, "mapped_", "reference"]
    rows = local.select(kept).unionByName(far.select(kept))
    # used twice, the bases are cut out before Python's rows are put together, which would otherwise hold whole windows
    rows = rows.withColumn("made", md_and_nm(F.when(F.col("mapped_") & F.col("reference").isNotNull(), F.col("cigar")), F.col("seq"), F.col("reference")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    new = {
        "tags": F.create_map(F.lit("NM"), F.col("made.nm").cast("string"), F.lit("MD"), F.col("made.md")),
        "tag_types": F.create_map(F.lit("NM"), F.lit("i"), F.lit("MD"), F.lit("Z")),
    }
    out = {}
    for name, more in new.items():
        old = F.coalesce(name, empty) if name in alignments.columns else empty
        kept = F.map_filter(old, lambda k, v: ~k.isin("MD", "NM"))
        out[name] = F.when(F.col("made.md").isNull(), old).otherwise(F.map_concat(kept, more))
    return rows.withColumns(out).select(*alignments.columns, *[c for c in out if c not in alignments.columns])
