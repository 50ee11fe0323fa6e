"""Command line: python -m strandlake COMMAND ... ; outputs are folders of text files."""

from __future__ import annotations

import argparse


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandlake", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, help: str, *paths: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=help)
        for path in paths:
            p.add_argument(path)
        return p

    p = command("make-families", "families from two FASTQ files", "fastq1", "fastq2", "out")
    p.add_argument("-t", "--tag-len", type=int, default=12)
    p.add_argument("-i", "--invariant", type=int, default=5)
    p = command("precheck", "totals of two FASTQ files", "fastq1", "fastq2")
    p.add_argument("-t", "--tag-len", type=int, default=12)
    p.add_argument("-m", "--min-reads", type=int, default=3)
    p = command("correct", "families with corrected barcodes", "families", "out")
    p.add_argument("--dist", type=int, default=1)
    p.add_argument("--pos", type=int, default=2)
    p.add_argument("--choose-by", choices=("count", "connect"), default="count")
    p.add_argument("--prepend", action="store_true")
    p.add_argument("--limit", type=int, help="lines of the input to read")
    p.add_argument("-S", "--structures", action="store_true", help="print the structures of the graph of similar barcodes")
    p.add_argument("--struct-human", action="store_true", help="print them in aligned columns")
    p.add_argument("-n", "--no-output", dest="output", action="store_false", help="write no families")
    p = command("shapes", "structures of the graph of similar barcodes", "families")
    p.add_argument("--tsv", action="store_true")
    p = command("kmers", "barcodes that share k-mers, aligned and held against their consensus", "families", "out")
    p.add_argument("-w", "--win-len", type=int, default=8)
    p.add_argument("-s", "--shift", type=int, default=0)
    p.add_argument("-n", "--num-barcodes", type=int)
    p = command("simulate", "read pairs of fragments of a FASTA reference: OUT_1, OUT_2, and what they come from", "fasta", "out")
    p.add_argument("-n", "--n-frags", type=int, default=1000)
    p.add_argument("-f", "--frag-len", type=int, default=400)
    p.add_argument("-r", "--read-len", type=int, default=100)
    p.add_argument("-s", "--seq-error", type=float, default=0.001)
    p.add_argument("-p", "--pcr-error", type=float, default=0.001)
    p.add_argument("-c", "--cycles", type=int, default=25)
    p.add_argument("-i", "--indel-rate", type=float, default=0.15)
    p.add_argument("-E", "--extension-rate", type=float, default=0.3)
    p.add_argument("-B", "--bar-len", type=int, default=12)
    p.add_argument("-I", "--invariant", default="TGACT")
    p.add_argument("-Q", "--qual", default="I")
    p.add_argument("-S", "--seed", type=int, default=1)
    command("label", "consensus sequences with the fragments they come from", "consensus", "families", "out")
    p = command("check", "labelled consensus sequences against their fragments", "labelled", "fragments", "out")
    p.add_argument("-i", "--ignore-ambiguous", action="store_true")
    p.add_argument("-a", "--print-alignments", action="store_true", help="write the alignments to OUT_alignments")
    p.add_argument("-S", "--no-stats", dest="stats", action="store_false", help="write no statistics")
    p = command("align", "aligned families", "families", "out")
    p.add_argument("--aligner", choices=("profile", "star", "mafft"), default="profile")
    p = command("duplex", "consensus of aligned families, by mate: OUT_1, OUT_2 and, with --sscs, OUT_sscs", "msa", "out")
    p.add_argument("-r", "--min-reads", type=int, default=3)
    p.add_argument("-q", "--qual", type=int, default=20)
    p.add_argument("-F", "--qual-format", default="sanger")
    p.add_argument("-c", "--cons-thres", type=float, default=0.5)
    p.add_argument("--incl-sscs", action="store_true")
    p.add_argument("--sscs", action="store_true")
    p = command("errstats", "errors of aligned families", "msa", "out")
    p.add_argument("-q", "--qual", type=int, default=0)
    p.add_argument("-r", "--all-repeats", action="store_true")
    command("consensus", "consensus of a FASTA alignment", "fasta")
    p = command("stats", "statistics of a marked alignment", "msa", "out")
    p.add_argument("stats", nargs="?", default="diffs")
    p = command("filter", "families whose barcodes have no long stretch of one base", "families", "out")
    p.add_argument("-r", "--repeats", type=int)
    p = command("subsample", "a share of the families", "families", "out")
    p.add_argument("-f", "--fraction", type=float, default=0.1)
    p.add_argument("-s", "--seed", type=int, default=1)
    p = command("pcr", "probabilities of minor alleles")
    p.add_argument("-k", "--cycles", type=int, default=25)
    p.add_argument("-n", type=int, default=10)
    p.add_argument("-x", type=int)
    p.add_argument("-1", "--1-sided", "--single", dest="single", action="store_true")
    p.add_argument("-2", "--2-sided", dest="single", action="store_false")
    p.set_defaults(single=False)
    return top


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from strandlake.operators import barcodes, consensus, correction, msa, qc, scratch, simulate
    from strandlake.sources import readers, writers

    spark = SparkSession.builder.appName("strandlake").getOrCreate()

    def tsv(df, path):
        columns = [F.array_join(F.col(c).cast("array<string>"), "\t") if kind.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, kind in df.dtypes]
        writers.write_lines(df.select(F.concat_ws("\t", *columns).alias("value")), path)

    if a.command == "make-families":
        writers.write_lines(writers.family_lines(barcodes.make_families(readers.read_pairs(spark, a.fastq1, a.fastq2), a.tag_len, a.invariant)), a.out)
    elif a.command == "precheck":
        pairs = readers.read_pairs(spark, a.fastq1, a.fastq2, check_names=True)
        tags = pairs.select(*[F.substr(f"seq{k}", F.lit(1), F.lit(a.tag_len)).alias(f"tag{k}") for k in (1, 2)])
        for r in barcodes.precheck_report(barcodes.precheck(tags, a.min_reads)).collect():
            print(r.stat, r.value, sep="\t")
    elif a.command == "correct":
        fam = readers.read_families(spark, a.families, a.limit)
        edges = scratch.materialise(correction.neighbours(fam, dist=a.dist, pos=a.pos), "neighbours")
        if a.structures or a.struct_human:
            for r in correction.shape_lines(correction.component_shapes(edges), a.struct_human).collect():
                print(r.value)
        if a.output:
            tsv(correction.correct_families(fam, edges, choose_by=a.choose_by, prepend=a.prepend), a.out)
    elif a.command == "shapes":
        fam = readers.read_families(spark, a.families)
        for r in correction.shape_lines(correction.component_shapes(correction.neighbours(fam)), not a.tsv).collect():
            print(r.value)
    elif a.command == "kmers":
        fam = readers.read_families(spark, a.families)
        fam = barcodes.first_barcodes(fam, a.num_barcodes) if a.num_barcodes else fam
        tsv(qc.fuzzy_groups(qc.kmer_members(fam, a.win_len, a.shift)), a.out)
    elif a.command == "simulate":
        reference = "".join(r.seq for r in readers.read_fasta(spark, a.fasta).orderBy("path", "rec").select("seq").collect())
        options = {k: getattr(a, k) for k in ("n_frags", "frag_len", "read_len", "seq_error", "pcr_error", "cycles", "indel_rate", "extension_rate", "bar_len", "invariant", "qual", "seed")}
        reads = scratch.materialise(simulate.simulate(spark, reference, **options), "simulated")
        for k in (1, 2):
            record = F.concat(F.lit("@"), f"name{k}", F.lit("\n"), f"seq{k}", F.lit("\n+\n"), f"qual{k}")
            writers.write_lines(reads.orderBy("frag", "read").select(record.alias("value")), f"{a.out}_{k}")
        tsv(simulate.mutation_log(reads), f"{a.out}_mutations")
        tsv(simulate.barcode_log(reads), f"{a.out}_barcodes")
        tsv(reads.select("chrom", "frag_id", "fragment").distinct(), f"{a.out}_fragments")
    elif a.command == "label":
        head = readers.parse_consensus_header("name")
        called = readers.read_fasta(spark, a.consensus).select(head["barcode"].alias("barcode"), head["mate"].alias("mate"), head["n_reads"].alias("n_reads"), "seq")
        rows = simulate.label_consensus(called, readers.read_families(spark, a.families))
        tsv(rows.withColumn("n_reads", F.array_join(F.col("n_reads").cast("array<string>"), "-")), a.out)
    elif a.command == "check":
        columns = ("chrom", "frag_num", "frag_id", "barcode", "mate", "n_reads", "seq")
        rows = readers.table(spark, a.labelled, columns).withColumn("mate", F.col("mate").try_cast("int")).withColumn("n_reads", F.split("n_reads", "-").cast("array<int>"))
        found = simulate.check_consensus(rows, readers.table(spark, a.fragments, ("chrom", "frag_id", "fragment")), a.ignore_ambiguous, a.print_alignments)
        if a.print_alignments:
            found = scratch.materialise(found, "checked")
            writers.write_lines(found.select(F.concat(F.concat_ws(".", "barcode", F.col("mate").cast("string")), F.lit("\n"), "alignment", F.lit("\n")).alias("value")), f"{a.out}_alignments")
        if a.stats:
            tsv(found.drop("alignment").withColumn("n_reads", F.array_join(F.col("n_reads").cast("array<string>"), "-")), a.out)
    elif a.command == "align":
        writers.write_lines(writers.msa_lines(msa.align_families(readers.read_families(spark, a.families), a.aligner)), a.out)
    elif a.command == "duplex":
        rows, options = readers.read_msa(spark, a.msa), {"min_reads": a.min_reads, "qual_thres": a.qual, "qual_format": a.qual_format, "cons_thres": a.cons_thres}
        calls = consensus.all_calls(rows, incl_sscs=a.incl_sscs, sscs=a.sscs, **options)
        writers.write_tagged(writers.tagged_fasta(calls), a.out, ["1", "2", "sscs"] if a.sscs else ["1", "2"])
    elif a.command == "errstats":
        columns = ["repeat_votes"] if a.all_repeats else ["repeat_errors", "errors"]
        tsv(qc.error_statistics(readers.read_msa(spark, a.msa), a.qual).select("barcode", "order", "mate", "n_reads", *columns), a.out)
    elif a.command == "consensus":
        print(consensus.alignment_consensus(readers.read_fasta(spark, a.fasta)).first().consensus)
    elif a.command == "stats":
        tsv(qc.read_statistics(readers.read_marked_msa(spark, a.msa), a.stats.split(",")), a.out)
    elif a.command == "filter":
        writers.write_lines(writers.family_lines(barcodes.filter_repeats(readers.read_families(spark, a.families), a.repeats)), a.out)
    elif a.command == "subsample":
        writers.write_lines(writers.family_lines(barcodes.subsample(readers.read_families(spark, a.families), a.fraction, a.seed)), a.out)
    elif a.command == "pcr":
        for r in qc.minor_allele_table(spark, a.cycles, a.n, a.single, a.x).orderBy("x").collect():
            print(r.k, r.n, r.x, r.p, sep="\t")


if __name__ == "__main__":
    main()
