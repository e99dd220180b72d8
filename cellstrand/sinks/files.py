"""Writers: FASTQ, SAM and BAM, tables, Matrix Market, JSON summary, rank plot."""

from __future__ import annotations

import gzip
import json
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.functions.sequence import header
from cellstrand.session import qualified
from cellstrand.sources.files import file_system, make_folder

#: Tags that are text even if they look like numbers, where nothing says what they are; and numbers without anything to spare.
TEXT_TAGS, NUMBER = ("MD", "CB", "UR", "UB", "RG"), r"^(0|-?[1-9]\d{0,8})$"


def fastq(reads: DataFrame, mate: str, folder: str) -> None:
    """Records of struct `mate` (name, desc, seq, qual) as gzip FASTQ parts, in order of idx within each part."""
    m = F.col(mate)
    record = F.concat_ws("\n", F.concat(F.lit("@"), header(m["name"], m["desc"])), m["seq"], F.lit("+"), m["qual"])
    reads.sortWithinPartitions("idx").select(record.alias("value")).write.mode("overwrite").option("compression", "gzip").text(folder)


def joined(folder: str, path: str, head: bytes = b"", suffix: str = "", tail: bytes = b"") -> None:
    """Part files of a folder, in any store, as one file; gzip members may be put behind each other."""
    make_folder(path)
    fs, inner = file_system(folder)
    to, place = file_system(path)
    with to.open_output_stream(place, compression=None) as out:
        out.write(head)
        for part in sorted(fs.get_file_info(pafs.FileSelector(inner)), key=lambda f: f.path):
            if part.base_name.startswith("part-") and part.base_name.endswith(suffix):
                with fs.open_input_stream(part.path, compression=None) as content:
                    while piece := content.read(1 << 20):
                        out.write(piece)
        out.write(tail)
    fs.delete_dir(inner)


def remove(folder: str) -> None:
    """Delete a folder, in any store, if it is there."""
    fs, inner = file_system(folder)
    if fs.get_file_info(inner).type != pafs.FileType.NotFound:
        fs.delete_dir(inner)


def tsv(table: DataFrame, path: str) -> None:
    """A table with header as one file at path."""
    path = qualified(table.sparkSession, path)
    table.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(f"{path}.parts")
    joined(f"{path}.parts", path, suffix=".csv")


def json_summary(table: DataFrame, path: str) -> None:
    """(read_class, count) as one JSON object."""
    path = qualified(table.sparkSession, path)
    make_folder(path)
    fs, inner = file_system(path)
    with fs.open_output_stream(inner, compression=None) as out:
        out.write(json.dumps({r.read_class: r["count"] for r in table.collect()}, indent=2).encode())


def matrix_market(cells: DataFrame, rows: int, columns: int, path: str) -> None:
    """(row, col, value) from 1 as a coordinate file of integers, in column order."""
    path = qualified(cells.sparkSession, path)
    lines = cells.orderBy("col", "row").select(F.concat_ws(" ", "row", "col", "value").alias("value"))
    count = cells.count()
    lines.write.mode("overwrite").text(f"{path}.parts")
    joined(f"{path}.parts", path, f"%%MatrixMarket matrix coordinate integer general\n%\n{rows} {columns} {count}\n".encode(), ".txt")


def _letter(kind: Column, tag: Column) -> Column:
    """The type of a tag in text, where all integers are i; what nothing tells the type of is a number or text by its looks."""
    number = tag["value"].rlike(NUMBER) & ~tag["key"].isin(*TEXT_TAGS)
    return F.when(kind.isin(*"cCsSiI"), "i").otherwise(F.coalesce(kind, F.when(number, "i").otherwise("Z")))


def sam_lines(alignments: DataFrame) -> DataFrame:
    """SAM text (value) of records."""
    types = F.col("tag_types") if "tag_types" in alignments.columns else F.lit(None).cast("map<string,string>")
    tags = F.transform(F.map_entries("tags"), lambda t: F.concat(t["key"], F.lit(":"), _letter(types[t["key"]], t), F.lit(":"), t["value"]))
    fields = ["qname", "flag", F.coalesce("rname", F.lit("*")), F.col("pos") + 1, "mapq", "cigar", "rnext", F.col("pnext") + 1, "tlen", "seq", "qual"]
    return alignments.select("idx", F.concat_ws("\t", *fields, F.array_join(tags, "\t")).alias("value")).withColumn("value", F.rtrim("value"))


def sam(alignments: DataFrame, head: Sequence[str], path: str) -> None:
    path = qualified(alignments.sparkSession, path)
    lines = sam_lines(alignments).orderBy("idx").select("value")
    lines.write.mode("overwrite").text(f"{path}.parts")
    joined(f"{path}.parts", path, "".join(f"{h}\n" for h in head).encode(), ".txt")


def rank_plot(curve: DataFrame, thresholds: DataFrame, path: str, most: int = 100_000) -> bool:
    """The barcode rank curve as PNG, from at most `most` points of it; False where no plotting library is installed."""
    try:
        import matplotlib

        matplotlib.use("Agg")
        from matplotlib import pyplot
    except ImportError:
        return False
    # all of the first ranks, then ranks in even steps of their logarithm
    step = F.floor(F.log10(F.col("rank") + 1) * (most // 20))
    points = curve.groupBy(step.alias("s")).agg(F.min("rank").alias("rank"), F.max("total_counts").alias("total"), F.max("highlight").alias("highlight")).orderBy("rank").limit(most).collect()
    figure, axes = pyplot.subplots(figsize=(7, 5))
    for above in (True, False):
        own = [p for p in points if p.highlight == above]
        axes.plot([p.rank + 1 for p in own], [p.total for p in own], label=str(above))
    axes.set(xscale="log", yscale="log", xlabel="Barcodes", ylabel="UMI Count", title="Barcode Rank Plot")
    axes.text(0.03, 0.05, "\n".join(f"Cells > {r.threshold:,} UMIs: {r.cells:,}" for r in thresholds.collect()), transform=axes.transAxes)
    axes.legend(title="UMIs > 1,000")
    path = qualified(curve.sparkSession, path)
    make_folder(path)
    fs, inner = file_system(path)
    with fs.open_output_stream(inner, compression=None) as out:
        figure.savefig(out, dpi=300, format="png")
    return True


def unpacked(path: str) -> bytes:
    with gzip.open(path, "rb") as data:
        return data.read()
