"""Command line: python -m cellstrand.cli COMMAND ..."""

from __future__ import annotations

import argparse

from cellstrand.plans import commands
from cellstrand.session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellstrand", description="Single-cell read processing on Spark")
    kinds = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, call, required: list[tuple[str, str]], **options) -> None:
        own = kinds.add_parser(name, help=text)
        for flag, of in required:
            own.add_argument(flag, dest=of, required=True)
        for flag, (of, settings) in options.items():
            own.add_argument(f"--{flag}", dest=of, **settings)
        own.set_defaults(call=call, wants=[of for _, of in required] + [of for of, _ in options.values()])

    number, real, yes = {"type": int}, {"type": float}, {"action": "store_true"}
    command(
        "barcode", "demultiplex and trim RNA reads", commands.barcode,
        [("--ligation_barcode_read_file", "ligation_reads"), ("--umi_cell_barcode_read_file", "umi_reads"), ("--biological_read_file", "biological_reads"), ("--output_basename", "output_basename"), ("--ligation_barcode_file", "ligation_file"), ("--RT_barcode_file", "rt_file"), ("--randomN_barcode_file", "random_n_file")],
        check_ids=("check_ids", yes), adapter_max_mismatches=("adapter_max_mismatches", number | {"default": 0}),
    )
    command(
        "trim", "trim adapters and ends of low quality", commands.trim, [("--r1", "r1"), ("--r2", "r2"), ("--output_basename", "output_basename")],
        adapter=("adapter", {"default": commands.ILLUMINA_ADAPTER}), adapter2=("adapter2", {"default": "A" * 8}), three_prime_clip_R1=("three_prime_clip_r1", number | {"default": 1}), three_prime_clip_R2=("three_prime_clip_r2", number | {"default": 0}),
        stringency=("stringency", number | {"default": 3}), quality=("quality", number | {"default": 20}), error_rate=("error_rate", real | {"default": 0.1}), length=("length", number | {"default": 20}),
    )
    command("tag", "write cell and UMI tags", commands.tag, [("--input_file", "input_file"), ("--output_file", "output_file")], num_processes=("num_processes", number | {"default": 1}))
    command("sort", "sort a BAM file by coordinate and index it", commands.sort, [("--input_file", "input_file"), ("--output_file", "output_file")])
    command("calmd", "make MD tags from a reference", commands.calmd, [("--input_file", "input_file"), ("--reference", "reference"), ("--output_file", "output_file")])
    command("index", "prepare an annotation", commands.index, [("--input_gtf", "input_gtf"), ("--output_file", "output")])
    command(
        "count", "assign read pairs to genes and count UMIs", commands.count,
        [("--input_bam", "input_bam"), ("--index_file", "index_file"), ("--output_dir", "output_dir"), ("--sample_name", "sample_name")],
        multigene_reads=("multigene_reads", {"default": "discard", "choices": ["discard", "closest_TES", "uniform", "prop_unique", "EM"]}),
        primer_type=("primer_type", {"default": "shortdT"}),
        library_strandedness=("library_strandedness", {"default": "reverse", "choices": ["reverse", "none"]}),
        read_subset=("read_subset", number), count_introns=("count_introns", yes), collapse_by_gene_name=("collapse_by_gene_name", yes), drop_unassigned=("drop_unassigned", yes),
    )
    command("merge", "merge count tables into a matrix", commands.merge, [("--count_files", "count_files"), ("--output_basename", "output_basename")])
    command(
        "slam", "keep nascent reads", commands.slam, [("--input_bam", "input_bam"), ("--output_bam", "output_bam")],
        snp_vcf=("snp_vcf", {}), min_base_quality=("min_base_quality", number | {"default": 45}), min_tc_ratio=("min_tc_ratio", real | {"default": 0.3}), min_tc_count=("min_tc_count", number | {"default": 1}), num_processes=("num_processes", number | {"default": 1}),
    )
    reads = [("--r1", "r1"), ("--r2", "r2"), ("--r3", "r3"), ("--ligation_barcode_file", "ligation_file"), ("--RT_barcode_file", "rt_file"), ("--inner_i7_barcode_file", "inner_i7_file")]
    place = [("--output_dir", "output_dir"), ("--sample_name", "sample_name")]
    command(
        "gRNA", "count guides", commands.guides, [*reads, ("--sgrna_barcode_file", "sgrna_file"), *place],
        sgrna_annotation_file=("annotation_file", {}), min_umi_threshold=("min_umi_threshold", number | {"default": 1}), n_reads=("n_reads", number),
    )
    command("gRNA-discover", "count sequences at the guide's place", commands.discover, [*reads, *place], n_reads=("n_reads", number))
    command("build-correction-dict", "one-mismatch dictionary of a whitelist", commands.build_dictionary, [("--input_file", "input_file"), ("--sequence_column", "sequence_column"), ("--output_file", "output_file")])
    return top


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    given.call(session(), **{of: getattr(given, of) for of in given.wants})


if __name__ == "__main__":
    main()
