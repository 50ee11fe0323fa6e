"""Named queries over the driver's tables, with equivalent SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions import scalar as S
from strandlake.operators import barcodes as B
from strandlake.operators import consensus as C
from strandlake.operators import correction as X
from strandlake.operators import msa as M
from strandlake.operators import qc as Q
from strandlake.operators import simulate as I
from strandlake.operators.align import ALIGNMENT_TYPE, align_pairs, near_align as near_align_column
from strandlake.operators.scratch import materialise, scratch_path
from strandlake.sources import readers as R
from strandlake.sources import writers as W

from . import reads as D

_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name; ``sql`` is a selection over the derived tables."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            body = sql.strip()
            _SQL[f.__name__] = f"with recursive {D.CTES.strip()}" + (f", {body[5:]}" if body.startswith("with ") else f" {body}")
        return f

    return add


def _ord(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("order", "ord")


# ---- families


@_query("select barcode, ord, name1, seq1, qual1, name2, seq2, qual2 from reads")
def make_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ord(B.make_families(D.raw_pairs(spark, sf_dir)))


@_query("select barcode, count(*) filter (ord = 'ab') n_ab, count(*) filter (ord = 'ba') n_ba, count(*) n_all from reads group by barcode")
def family_counts(spark, sf_dir):
    return B.family_counts(D.reads(spark, sf_dir))


@_query("select * from (select barcode, count(*) filter (ord = 'ab') n_ab, count(*) filter (ord = 'ba') n_ba from reads group by barcode) where n_ab >= 3 and n_ba >= 3")
def duplex_pairs(spark, sf_dir):
    return B.duplex_pairs(D.reads(spark, sf_dir), 3)


@_query("""with c as (select alpha, beta, count(*) n from reads group by 1, 2),
     b as (select c.n, d.n m from c left join c d on c.alpha = d.beta and c.beta = d.alpha)
select cast(sum(n) as bigint) pairs, count(*) barcodes, round(sum(n) / count(*), 6) avg_pairs, count(*) filter (n = 1) singletons,
       count(m) // 2 duplexes, count(*) filter (n >= 3) * 2 passed_sscs, count(*) filter (n >= 3 and m >= 3) passed_duplexes from b""")
def precheck_stats(spark, sf_dir):
    tags = D.reads(spark, sf_dir).select(F.col("alpha").alias("tag1"), F.col("beta").alias("tag2"))
    return B.precheck(tags).withColumn("avg_pairs", F.round("avg_pairs", 6))


@_query("""with h as (select *, list_max(list_transform(regexp_extract_all(substr(barcode, 1, 12), '(A+|C+|G+|T+|N+)', 1), lambda x: length(x))) r1,
     list_max(list_transform(regexp_extract_all(substr(barcode, 13), '(A+|C+|G+|T+|N+)', 1), lambda x: length(x))) r2 from reads)
select barcode, ord, name1 from h where greatest(r1, r2) <= 2""")
def filter_repeats(spark, sf_dir):
    return _ord(B.filter_repeats(D.reads(spark, sf_dir), 2)).select("barcode", "ord", "name1")


@_query("select barcode, ord, name1 from reads where cast('0x' || substr(md5('1-' || barcode), 1, 8) as bigint) < cast(floor(0.1 * 4294967296) as bigint)")
def subsample_hash(spark, sf_dir):
    return _ord(B.subsample(D.reads(spark, sf_dir), 0.1, 1)).select("barcode", "ord", "name1")


@_query("select distinct barcode from reads order by md5('1-' || barcode), barcode limit 100")
def random_families(spark, sf_dir):
    return B.random_families(D.reads(spark, sf_dir), 100)


@_query("select barcode, ord, name1 from reads where barcode in (select distinct barcode from reads order by barcode limit 50)")
def first_barcodes(spark, sf_dir):
    return _ord(B.first_barcodes(D.reads(spark, sf_dir), 50)).select("barcode", "ord", "name1")


@_query("with t2 as (select distinct alpha || beta barcode from reads) select barcode from t2 where substr(barcode, 13) || substr(barcode, 1, 12) in (select barcode from t2)")
def both_strand_barcodes(spark, sf_dir):
    return B.both_strand_barcodes(D.reads(spark, sf_dir).select(F.concat("alpha", "beta").alias("barcode")))


@_query("select row_number() over (order by barcode) num, barcode from (select distinct barcode from reads)")
def barcode_numbers(spark, sf_dir):
    return W.barcode_fasta(D.reads(spark, sf_dir))


@_query("""with n as (select row_number() over (order by barcode) num, barcode from (select distinct barcode from reads))
select cast(num as varchar) as name, barcode seq from n union all select num || ':rev' as name, substr(barcode, 13) || substr(barcode, 1, 12) seq from n""")
def barcode_references(spark, sf_dir):
    return W.barcode_references(W.barcode_fasta(D.reads(spark, sf_dir)))


@_query("""with b as (select *, count(distinct ord) over (partition by barcode) strands from msa), r as (select *, case
  when strands = 1 then mate - 1 when mate = 1 and ord = 'ab' then 0 when mate = 2 and ord = 'ba' then 1 when mate = 2 then 2 else 3 end rank from b)
select barcode, ord, mate, name, seq, row_number() over (partition by barcode order by rank, name, seq) emit_seq from r""")
def emission_order(spark, sf_dir):
    return _ord(B.emission_order(D.msa(spark, sf_dir))).select("barcode", "ord", "mate", "name", "seq", "emit_seq")


# ---- votes and consensus

_PLAIN = """with v as (select barcode, ord, mate, p pos, upper(substr(seq, p, 1)) base from msa, (select unnest(range(1, 33)) p)),
m as (select barcode, ord, mate, pos, count(*) filter (base = 'A') n_A, count(*) filter (base = 'C') n_C, count(*) filter (base = 'G') n_G,
      count(*) filter (base = 'T') n_T, count(*) filter (base = 'N') n_N, count(*) filter (base = '-') n_gap from v where base in ('A','C','G','T','N','-') group by all)"""
_SIDE = " + ".join(f"case when length({s}) >= {k} then ascii(substr({s}, {k}, 1)) * {5 - k} else 0 end" for s in ("l", "r") for k in range(1, 5))
_SIDE_W = " + ".join(f"case when length({s}) >= {k} then {5 - k} else 0 end" for s in ("l", "r") for k in range(1, 5))
_QUAL = f"""with w as (select barcode, ord, mate, p pos, upper(substr(seq, p, 1)) base, qual, reverse(replace(substr(qual, 1, p - 1), ' ', '')) l,
      replace(substr(qual, p + 1), ' ', '') r from msa, (select unnest(range(1, 33)) p)),
v as (select * from w where case when base = '-' then ({_SIDE}) // ({_SIDE_W}) else ascii(substr(qual, pos, 1)) end >= 53),
m as (select barcode, ord, mate, pos, count(*) filter (base = 'A') n_A, count(*) filter (base = 'C') n_C, count(*) filter (base = 'G') n_G,
      count(*) filter (base = 'T') n_T, count(*) filter (base = 'N') n_N, count(*) filter (base = '-') n_gap from v where base in ('A','C','G','T','N','-') group by all)"""
_CALL = """, f as (select barcode, ord, mate, count(*) n_reads from msa group by all having count(*) >= 3),
g as (select f.barcode, f.ord, f.mate, f.n_reads, p pos, n_A, n_C, n_G, n_T, n_N, n_gap, greatest(n_A, n_C, n_G, n_T, n_N, n_gap) top, n_A + n_C + n_G + n_T + n_N + n_gap total
      from f cross join (select unnest(range(1, 33)) p) left join m on m.barcode = f.barcode and m.ord = f.ord and m.mate = f.mate and m.pos = p),
s as (select barcode, ord, mate, n_reads, string_agg(case when total is null or total = 0 or top / total <= 0.5 then 'N' when n_A = top then 'A' when n_C = top then 'C'
      when n_G = top then 'G' when n_T = top then 'T' when n_N = top then 'N' else '-' end, '' order by pos) gapped from g group by all)"""


@_query(_PLAIN + " select * from m")
def vote_matrix(spark, sf_dir):
    return _ord(C.vote_matrix(D.msa(spark, sf_dir)))


@_query(_QUAL + " select * from m")
def vote_matrix_qual(spark, sf_dir):
    return _ord(C.vote_matrix(D.msa(spark, sf_dir), least=S.phred_char(20)))


@_query(_PLAIN + _CALL + " select barcode, ord, mate, n_reads, replace(gapped, '-', '') seq from s")
def sscs_simple(spark, sf_dir):
    return _ord(C.consensus_native(D.msa(spark, sf_dir)).withColumnRenamed("consensus", "seq"))


@_query(_QUAL + _CALL + " select barcode, ord, mate, n_reads, replace(gapped, '-', '') seq from s")
def sscs_native(spark, sf_dir):
    return _ord(C.consensus_native(D.msa(spark, sf_dir), least=S.phred_char(20)).withColumnRenamed("consensus", "seq"))


@_query(_QUAL + _CALL + " select barcode, ord, mate, n_reads, replace(gapped, '-', '') seq from s")
def sscs_consensus(spark, sf_dir):
    return _ord(C.single_strand(D.msa(spark, sf_dir)))


_MERGED = " ".join(f"when '{x}{y}' then '{c}'" for p, c in S.AMBIGUITY.items() for x, y in (p, p[::-1]))


@_query(_QUAL + _CALL + f""", d as (select a.barcode, a.mate, a.gapped x, b.gapped y from s a join s b on a.barcode = b.barcode and a.ord = 'ab' and b.ord = 'ba' and b.mate = 3 - a.mate)
select barcode, mate, string_agg(case when substr(x, p, 1) = substr(y, p, 1) and substr(x, p, 1) <> 'N' then substr(x, p, 1) else case substr(x, p, 1) || substr(y, p, 1) {_MERGED} else 'N' end end, '' order by p) seq
from d, (select unnest(range(1, 33)) p) group by barcode, mate""")
def duplex_iupac(spark, sf_dir):
    """Strands merged column by column: for families whose alignments share their columns."""
    s = C.consensus_native(D.msa(spark, sf_dir), least=S.phred_char(20), gapped=True)
    a = s.where("`order` = 'ab'").select("barcode", "mate", F.col("consensus").alias("x"))
    b = s.where("`order` = 'ba'").select("barcode", (3 - F.col("mate")).alias("mate"), F.col("consensus").alias("y"))
    return a.join(b, ["barcode", "mate"]).select("barcode", "mate", S.merge_bases("x", "y").alias("seq"))


_SHARES = ", ".join(f"max(case when ord = '{o}' then n_{b} / (n_A + n_C + n_G + n_T + n_N + n_gap) end) {o}_{b}" for b in ("A", "C", "G", "T", "N", "gap") for o in ("ab", "ba"))
_MEANS = ", ".join(f"(ab_{b} + ba_{b}) / 2 f{b}" for b in ("A", "C", "G", "T", "N", "gap"))


@_query(_PLAIN + f""", q as (select barcode, cast(case when ord = 'ab' then mate else 3 - mate end as int) mate, pos, {_SHARES} from m group by 1, 2, 3),
j as (select barcode, mate, pos, {_MEANS} from q where ab_A is not null and ba_A is not null), k as (select *, greatest(fA, fC, fG, fT, fN, fgap) top from j)
select barcode, mate, pos, case when top <= 0.5 then 'N' when fA = top then 'A' when fC = top then 'C' when fG = top then 'G' when fT = top then 'T' when fN = top then 'N' else '-' end base from k""")
def duplex_freq(spark, sf_dir):
    return C.duplex_shares(D.msa(spark, sf_dir))


@_query(_QUAL + _CALL + " select barcode, ord, mate, n_reads, replace(gapped, '-', '') seq from s")
def sscs_by_sql(spark, sf_dir):
    """Single-strand consensus from SQL alone: a table function over the families as partitions."""
    from strandlake.functions import tables

    tables.register(spark)
    D.msa(spark, sf_dir).createOrReplaceTempView("strandlake_msa")
    return spark.sql("select barcode, `order` as ord, mate, n_reads, seq from call_consensus(table(strandlake_msa) partition by (barcode, `order`, mate))")


@_query()
def dcs_full(spark, sf_dir):
    return C.duplex(D.msa(spark, sf_dir)).withColumn("n_reads", F.array_join(F.col("n_reads").cast("array<string>"), "-"))


@_query()
def dcs_incl_sscs(spark, sf_dir):
    return C.duplex(D.msa(spark, sf_dir), incl_sscs=True).withColumn("n_reads", F.array_join(F.col("n_reads").cast("array<string>"), "-"))


@_query(_QUAL + _CALL + """, z as (select *, replace(gapped, '-', '') seq from s)
select a.barcode, a.ord, a.n_reads n1, a.seq seq1, b.n_reads n2, b.seq seq2 from z a join z b on a.barcode = b.barcode and a.ord = b.ord and a.mate = 1 and b.mate = 2""")
def sscs_pairing(spark, sf_dir):
    return _ord(W.pair_mates(C.single_strand(D.msa(spark, sf_dir))))


@_query(_QUAL + _CALL + " select '>' || barcode || '.' || ord || '.' || mate || ' ' || n_reads || chr(10) || replace(gapped, '-', '') as value from s")
def fasta_split(spark, sf_dir):
    return W.sscs_fasta(C.single_strand(D.msa(spark, sf_dir)))


@_query()
def msa_center_star(spark, sf_dir):
    return _ord(M.align_families(D.reads(spark, sf_dir)))


@_query("select barcode, ord, name1, barcode || chr(9) || ord || chr(9) || name1 || chr(9) || seq1 || chr(9) || qual1 || chr(9) || name2 || chr(9) || seq2 || chr(9) || qual2 as value from reads")
def family_lines(spark, sf_dir):
    df = D.reads(spark, sf_dir)
    return df.select("barcode", F.col("order").alias("ord"), "name1", F.concat_ws("\t", *R.FAMILY_COLUMNS).alias("value"))


@_query("select barcode, ord, name1, seq1, qual1, name2, seq2, qual2 from reads")
def fastq_to_families(spark, sf_dir):
    """The pairs written as two FASTQ files, read back by record and made into families."""
    pairs, paths = D.raw_pairs(spark, sf_dir), []
    for k in (1, 2):
        record = F.concat(F.lit("@"), f"name{k}", F.lit("\n"), f"seq{k}", F.lit("\n+\n"), f"qual{k}")
        paths.append(scratch_path(spark, f"fastq{k}"))
        pairs.select(record.alias("value")).write.text(paths[-1])
    return _ord(B.make_families(R.read_pairs(spark, *paths)))


@_query("select name1 as name, 'GCATC' || seq1 as seq, alpha || 'GCATC' || seq1 as whole, repeat('I', 17) || qual1 as qual from reads")
def fastq_folded(spark, sf_dir):
    """First mates written as FASTQ over several lines a record, read by byte ranges of 64 KB."""
    path = scratch_path(spark, "folded")
    fold = lambda c, n: F.regexp_replace(c, f"(.{{{n}}})(?=.)", "$1\n")
    record = F.concat(F.lit("@"), "name1", F.lit("\n"), fold("seq1", 13), F.lit("\n+\n"), fold("qual1", 11))
    D.raw_pairs(spark, sf_dir).select(record.alias("value")).write.text(path)
    R.datasource.register(spark)
    rows = spark.read.format("fastq").schema("name string, seq string, qual string").options(split=1 << 16, most=1 << 12).load(path)
    return rows.select("name", F.substr("seq", F.lit(13)).alias("seq"), F.col("seq").alias("whole"), "qual")


@_query("""select c.k as tag, count(*) as n from (select barcode, ord, count(*) c from reads group by 1, 2 having count(*) >= 3) f, (select unnest(['ab1', 'ab2', 'ba1', 'ba2']) k) c where substr(c.k, 1, 2) = ord group by 1""")
def strands_from_one_pass(spark, sf_dir):
    """Single strands and duplexes from one alignment stage, written by one job to tagged folders, and the strands counted from what was written."""
    path = scratch_path(spark, "calls")
    W.write_tagged(W.tagged_fasta(C.all_calls(D.msa(spark, sf_dir))), path, ["1", "2", "sscs"])
    head = R.parse_consensus_header("name")
    return R.read_fasta(spark, f"{path}_sscs").groupBy(F.concat(head["order"], head["mate"].cast("string")).alias("tag")).agg(F.count("*").alias("n"))


@_query("select barcode, ord, mate, name, seq, qual from msa")
def msa_round_trip(spark, sf_dir):
    """Aligned families written as text and read back; gaps' qualities are spaces that must stay."""
    path = scratch_path(spark, "msa")
    W.write_lines(W.msa_lines(D.msa(spark, sf_dir)), path)
    return _ord(R.read_msa(spark, path))


@_query(_QUAL + _CALL + " select barcode || '.' || ord || '.' || mate || ' ' || n_reads as name, barcode || '.' || ord || '.' || mate id, replace(gapped, '-', '') seq from s")
def fasta_round_trip(spark, sf_dir):
    """Consensus sequences written as FASTA and read back as records."""
    path = scratch_path(spark, "fasta")
    W.write_lines(W.sscs_fasta(C.single_strand(D.msa(spark, sf_dir))), path)
    return R.read_fasta(spark, path).select("name", "id", "seq")


@_query("""with a as (select cast(l_orderkey as varchar) qname, cast(l_partkey as varchar) rname, l_suppkey % 3 = 0 reversed, cast(l_suppkey % 8 as int) flag,
  cast(l_linenumber as int) pos, cast(l_quantity as int) mapq, cast(l_partkey % 4 as int) nm from lineitem)
select qname, rname, reversed, flag, pos, mapq, nm from a where flag & 4 = 0 and abs(pos - 1) <= 2 and mapq >= 20 and nm <= 1""")
def sam_filters(spark, sf_dir):
    """Lines of an alignment file made of the lines of orders, read with the default filters."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = lambda c: c.cast("string")
    target = F.concat(text(F.col("l_partkey")), F.when(F.col("l_suppkey") % 3 == 0, ":rev").otherwise(""))
    fields = [
        text(F.col("l_orderkey")), text(F.col("l_suppkey") % 8), target, text(F.col("l_linenumber")), text(F.col("l_quantity").cast("int")), F.lit("24M"),
        F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"), F.lit("AS:i:7"), F.concat(F.lit("NM:i:"), text(F.col("l_partkey") % 4)),
    ]
    path = scratch_path(spark, "sam")
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    return R.read_alignments(spark, path)


_WEIGHED = _QUAL.split(",\nv as")[0] + f""", v as (select barcode, ord, mate, pos, base, case when base = '-' then ({_SIDE}) // ({_SIDE_W}) else ascii(substr(qual, pos, 1)) end - 33 q from w)"""


@_query(_WEIGHED + " select barcode, ord, mate, pos, " + ", ".join(f"cast(coalesce(sum(q) filter (base = '{b}'), 0) as bigint) n_{n}" for b, n in zip("ACGTN-", ("A", "C", "G", "T", "N", "gap"))) + " from v where base in ('A','C','G','T','N','-') group by all")
def vote_matrix_weighted(spark, sf_dir):
    return _ord(C.weighted_vote_matrix(D.msa(spark, sf_dir)))


@_query("""with c as (select alpha, beta, count(*) n from reads group by 1, 2), b as (select c.n, d.n m from c left join c d on c.alpha = d.beta and c.beta = d.alpha),
x as (select cast(sum(n) as double) pairs, cast(count(*) as double) barcodes, cast(count(*) filter (n = 1) as double) singletons, cast(count(*) filter (n >= 3) * 2 as double) passed from b)
select 'pairs' stat, pairs as value from x union all select 'barcodes', barcodes from x union all select 'singletons', singletons from x union all select 'passed_sscs', passed from x""")
def precheck_report(spark, sf_dir):
    tags = D.reads(spark, sf_dir).select(F.col("alpha").alias("tag1"), F.col("beta").alias("tag2"))
    return B.precheck_report(B.precheck(tags)).where("stat in ('pairs', 'barcodes', 'singletons', 'passed_sscs')")


@_query(_QUAL + _CALL.replace("count(*) >= 3", "count(*) >= 1") + """ select msa.barcode, msa.ord, msa.mate, name, gapped consensus, array_to_string(list_transform(range(1, 33), lambda i:
  case when substr(seq, i, 1) <> '-' and ascii(substr(qual, i, 1)) < 53 then ' ' when substr(seq, i, 1) = substr(gapped, i, 1) then '.' else substr(seq, i, 1) end), '') marked
from msa join s on s.barcode = msa.barcode and s.ord = msa.ord and s.mate = msa.mate""")
def marked_alignment(spark, sf_dir):
    return _ord(M.marked_alignment(D.msa(spark, sf_dir)))


# ---- scalar functions


@_query("""select name1, translate(reverse(concat(seq1, 'KSWRUn')), 'ABCDGHKMNRSTUVWYabcdghkmnrstuvwy', 'TVGHCDMKNYWAABSRtvghcdmknywaabsr') rc from reads""")
def revcomp_c(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.reverse_complement(F.concat("seq1", F.lit("KSWRUn")), swapping=True).alias("rc"))


@_query("""select name1, translate(reverse(concat(seq1, 'KSWRUn')), 'acgtrymkbdhvACGTRYMKBDHV', 'tgcayrkmvhdbTGCAYRKMVHDB') rc from reads""")
def revcomp_py(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.reverse_complement(F.concat("seq1", F.lit("KSWRUn"))).alias("rc"))


@_query("select name1, substr(barcode, 13) || substr(barcode, 1, 12) swapped from reads")
def swap_halves(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.swap_halves("barcode").alias("swapped"))


@_query("select name1, replace(gseq, '-', '') seq from reads")
def rm_gaps(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.remove_gaps("gseq").alias("seq"))


@_query("""select name1, array_to_string(list_transform(range(1, length(gseq) + 1), lambda i: case when substr(gseq, i, 1) = '-' then ' '
  else substr(qual1, length(replace(substr(gseq, 1, i), '-', '')), 1) end), '') moved from reads""")
def transfer_gaps(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.transfer_gaps("gseq", "qual1", "-", " ").alias("moved"))


@_query("select name1, list_max(list_transform(regexp_extract_all(seq1, '(A+|C+|G+|T+|N+)', 1), lambda x: length(x))) run from reads")
def longest_run(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.longest_run("seq1").cast("long").alias("run"))


@_query("""select name1, array_to_string(list_transform(range(1, 33), lambda i: case when substr(gseq, i, 1) <> '-' and ascii(substr(gqual, i, 1)) < 58 then ' '
  when substr(gseq, i, 1) = substr(s0, i, 1) then '.' else substr(gseq, i, 1) end), '') marked from reads""")
def mark_differences(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.mark_differences("gseq", "s0", "gqual", S.phred_char(25)).alias("marked"))


@_query("""select name1, case when pk % 3 = 0 then substr(seq2, 1, cast(pk % 30 as int)) || 'T' || substr(seq2, cast(pk % 30 as int) + 2)
  when pk % 3 = 1 then substr(seq2, 1, cast(pk % 30 as int)) || 'GG' || substr(seq2, cast(pk % 30 as int) + 1)
  else substr(seq2, 1, cast(pk % 30 as int)) || substr(seq2, cast(pk % 30 as int) + 3) end seq from reads""")
def apply_mutation(spark, sf_dir):
    kind = F.when(F.col("pk") % 3 == 0, "snv").when(F.col("pk") % 3 == 1, "ins").otherwise("del")
    alt = F.when(kind == "snv", "T").otherwise("GG")
    return D.reads(spark, sf_dir).select("name1", S.apply_mutation("seq2", kind, F.col("pk") % 30, alt, F.lit(2)).alias("seq"))


@_query("""select name1, case when n = 0 then '' when n <= 26 then chr(cast(64 + n as int)) else chr(cast(64 + (n - 27) // 26 + 1 as int)) || chr(cast(65 + (n - 27) % 26 as int)) end code
from (select name1, pk % 700 n from reads)""")
def number_letters(spark, sf_dir):
    return D.reads(spark, sf_dir).select("name1", S.letters(F.col("pk") % 700).alias("code"))


@_query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when l_extendedprice = 0 then 0 else
  round(l_extendedprice * pow(10, 2 - floor(log10(abs(l_extendedprice))))) / pow(10, 2 - floor(log10(abs(l_extendedprice)))) end, 6) price from lineitem""")
def round_significant(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(S.round_significant("l_extendedprice", 3), 6).alias("price"))


@_query("""select name1, barcode, ord, mate, n1, n2 from (select name1, barcode, ord, cast(pk % 2 + 1 as int) mate, cast(pk % 50 as int) n1, cast(sk % 50 as int) n2 from reads)""")
def consensus_headers(spark, sf_dir):
    rows = D.reads(spark, sf_dir)
    header = F.concat("barcode", F.lit("."), "order", F.lit("."), (F.col("pk") % 2 + 1).cast("string"), F.lit(" "), (F.col("pk") % 50).cast("string"), F.lit("-"), (F.col("sk") % 50).cast("string"))
    p = R.parse_consensus_header(header)
    return rows.select("name1", p["barcode"].alias("barcode"), p["order"].alias("ord"), p["mate"].alias("mate"), p["n_reads"][0].alias("n1"), S.family_sizes(header)[1].alias("n2"))


@_query("select name1, 'chr' || (k % 22) chrom, cast(ln as int) as start, cast(ln + 400 as int) as stop, k frag from reads")
def read_names(spark, sf_dir):
    rows = D.reads(spark, sf_dir)
    name = F.concat(F.lit("chr"), (F.col("k") % 22).cast("string"), F.lit("_"), F.col("ln").cast("string"), F.lit("_"), (F.col("ln") + 400).cast("string"), F.lit("_0:0:0_0:0:0_"), F.lower(F.hex("k")), F.lit("/1"))
    p = S.read_id(name)
    return rows.select("name1", p["chrom"].alias("chrom"), p["start"].alias("start"), p["stop"].alias("stop"), S.fragment_number(p["frag"]).alias("frag"))


@_query("select name1, case when ord = 'ab' then seq1 else seq2 end seq from reads where ord = 'ab'")
def duplex_reads(spark, sf_dir):
    return R.duplex_reads(D.reads(spark, sf_dir), 1, "ab").select(F.col("name").alias("name1"), "seq")


@_query("select name1 as name, p coord, substr(seq1, p, 1) base from reads, (select unnest(range(1, 33)) p)")
def fasta_bases(spark, sf_dir):
    return R.fasta_bases(D.reads(spark, sf_dir).select(F.col("name1").alias("name"), F.col("seq1").alias("seq")))


# ---- correction

_NEAR = " or ".join(f"levenshtein(src, substr(t, {o + 1}, 24 + {d})) <= 1" for o in range(3) for d in (-1, 0, 1)).replace("24 + -1", "23")
_EDGES = f"""with b as (select distinct barcode from bars),
q as (select barcode src, 0 part, substr(barcode, 1, 12) seed from b union all select barcode, 1, substr(barcode, 13, 12) from b),
g as (select barcode dst, barcode t, false reversed from b union all select barcode, substr(barcode, 13) || substr(barcode, 1, 12), true from b),
x as (select dst, t, reversed, 0 part, substr(t, 1 + o, 12) seed from g, (select unnest(range(0, 4)) o) union all
      select dst, t, reversed, 1, substr(t, 13 + o, 12) from g, (select unnest(range(-1, 4)) o)),
c as (select distinct src, dst, t, reversed from q join x using (part, seed) where src <> dst),
e as (select src, dst, reversed from c where {_NEAR})"""
_PARTS = """, y as (select src, dst from e union select dst, src from e),
w(node, reach) as (select src, src from y union select w.node, y.dst from w join y on w.reach = y.src),
p as (select node barcode, min(reach) component from w group by node)"""
_FIX = """, n as (select barcode, count(*) n from bars group by barcode),
h as (select p.barcode, component, first_value(p.barcode) over (partition by component order by n.n desc, p.barcode) correct from p join n on n.barcode = p.barcode)"""


@_query(_EDGES + " select src, dst, reversed from e")
def barcode_neighbors(spark, sf_dir):
    return X.neighbours(D.noisy_families(spark, sf_dir))


@_query(_EDGES + _PARTS + " select barcode, component from p")
def barcode_components(spark, sf_dir):
    return X.barcode_components(X.neighbours(D.noisy_families(spark, sf_dir)))


@_query(_EDGES + _PARTS + _FIX + " select barcode, correct from h where barcode <> correct")
def correction_table(spark, sf_dir):
    fam = D.noisy_families(spark, sf_dir)
    return X.correction_table(X.neighbours(fam), B.family_counts(fam))


@_query(_EDGES + _PARTS + _FIX + " select coalesce(correct, bars.barcode) barcode, ord, name1 from bars left join h on h.barcode = bars.barcode")
def corrected_families(spark, sf_dir):
    fam = D.noisy_families(spark, sf_dir)
    return _ord(X.correct_families(fam, X.neighbours(fam))).select("barcode", "ord", "name1")


@_query()
def component_shapes(spark, sf_dir):
    return X.component_shapes(X.neighbours(D.noisy_families(spark, sf_dir))).withColumn("degrees", F.array_join(F.col("degrees").cast("array<string>"), ","))


@_query(_EDGES + _PARTS + """, dd as (select src barcode, count(distinct dst) deg from y where src <> dst group by src),
cc as (select component, count(*) size, string_agg(cast(deg as varchar), ',' order by deg desc) degrees, max(deg) = count(*) - 1 central from p join dd using (barcode) group by component)
select size, degrees, count(*) n, count(*) filter (central) central from cc group by size, degrees""")
def component_degrees(spark, sf_dir):
    """Components by size and degrees, over all structures that have them."""
    rows = X.component_shapes(X.neighbours(D.noisy_families(spark, sf_dir))).groupBy("size", F.array_join(F.col("degrees").cast("array<string>"), ",").alias("degrees"))
    return rows.agg(F.sum("n").alias("n"), F.sum("central").alias("central"))


@_query(_EDGES + _PARTS + """, dd as (select src barcode, count(distinct dst) deg from y where src <> dst group by src),
cc as (select component, count(*) size, list(deg order by deg desc) degrees, max(deg) = count(*) - 1 central from p join dd using (barcode) group by component),
ss as (select size, degrees, count(*) n, count(*) filter (central) central from cc where size <= 4 group by size, degrees)
select size, chr(64 + cast(row_number() over (partition by size order by n desc, degrees) as int)) ordinal, n, central, array_to_string(degrees, ',') degrees from ss""")
def component_shapes_of_four(spark, sf_dir):
    """Structures of up to four barcodes: each has degrees of its own."""
    rows = X.component_shapes(X.neighbours(D.noisy_families(spark, sf_dir))).where("size <= 4")
    return rows.withColumn("degrees", F.array_join(F.col("degrees").cast("array<string>"), ","))


@_query(_EDGES + """, n as (select barcode, count(*) filter (ord = 'ab') a, count(*) filter (ord = 'ba') b from bars group by barcode),
z as (select src barcode, sum(n.a) xa, sum(n.b) xb from (select distinct src, dst from e) d join n on n.barcode = d.dst group by src),
o as (select n.a, n.b, n.a + coalesce(xa, 0) aa, n.b + coalesce(xb, 0) bb from n left join z on z.barcode = n.barcode)
select count(*) families, count(*) filter (a >= 3 and b >= 3) passing, count(*) filter (aa >= 3 and bb >= 3) passing_with_neighbours from o""")
def rescued_families(spark, sf_dir):
    fam = D.noisy_families(spark, sf_dir)
    return X.rescued_families(fam.select("barcode").distinct(), X.neighbours(fam), B.family_counts(fam))


# ---- quality control


_ERRORS = """with r as (select *, row_number() over (partition by barcode, ord, mate order by name, seq, qual) rn from msa),
c as (select barcode, ord, mate, rn, p, substr(seq, p, 1) base, nullif(substr(qual, p, 1), ' ') q from r, (select unnest(range(1, 33)) p)),
l as (select *, last_value(q ignore nulls) over (partition by barcode, ord, mate, p order by rn) above,
      last_value(q ignore nulls) over (partition by barcode, ord, mate, p order by rn rows between unbounded preceding and unbounded following) final from c),
f as (select distinct barcode, ord, mate, p + 1 p, coalesce(final, '~') final from l),
k as (select l.*, coalesce(l.above, f.final, '~') q1, coalesce(l.above, '~') q2 from l left join f on f.barcode = l.barcode and f.ord = l.ord and f.mate = l.mate and f.p = l.p),
v as (select barcode, ord, mate, p, base, count(*) n from k where q1 >= '5' group by all),
tt as (select barcode, ord, mate, p, max(n) top from v group by all),
w as (select tt.barcode, tt.ord, tt.mate, tt.p, case when count(*) = 1 then min(v.base) else 'N' end cons from tt join v on v.barcode = tt.barcode and v.ord = tt.ord and v.mate = tt.mate and v.p = tt.p and v.n = tt.top group by all),
a as (select g.barcode, g.ord, g.mate, g.p, coalesce(w.cons, 'N') cons from (select distinct barcode, ord, mate, p from c) g left join w on w.barcode = g.barcode and w.ord = g.ord and w.mate = g.mate and w.p = g.p),
e as (select k.barcode, k.ord, k.mate, k.rn, count(*) filter (q2 >= '5' and base <> cons) n from k join a on a.barcode = k.barcode and a.ord = k.ord and a.mate = k.mate and a.p = k.p group by all),
o as (select v.*, position(base in 'ACGT-N') o from v join a on a.barcode = v.barcode and a.ord = v.ord and a.mate = v.mate and a.p = v.p where base <> cons),
x as (select barcode, ord, mate, count(*) n_reads, string_agg(cast(n as varchar), ',' order by rn) errors from e group by all),
y as (select barcode, ord, mate, count(*) filter (n > 1) repeat_errors, string_agg(cast(n as varchar), ',' order by p, o) repeat_votes from o group by all),
z as (select barcode, ord, mate, string_agg(cons, '' order by p) consensus from a group by all)
select x.barcode, x.ord, x.mate - 1 mate, n_reads, coalesce(repeat_errors, 0) repeat_errors, errors, coalesce(repeat_votes, '') repeat_votes, consensus
from x join z on z.barcode = x.barcode and z.ord = x.ord and z.mate = x.mate left join y on y.barcode = x.barcode and y.ord = x.ord and y.mate = x.mate"""


@_query(_ERRORS)
def errstats(spark, sf_dir):
    rows = _ord(Q.error_statistics(D.msa(spark, sf_dir), 20))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return rows.select("barcode", "ord", "mate", "n_reads", "repeat_errors", text("errors"), text("repeat_votes"), "consensus")


@_query("""select name1, gseq, round(diffs / 32, 6) diffs from (select r.name1, r.gseq, (select count(*) from (select unnest(range(1, 33)) p) where substr(r.s0, p, 1) <> substr(r.gseq, p, 1)
  and (substr(r.gseq, p, 1) <> '-' or p = 1 or substr(r.gseq, p - 1, 1) <> '-')) diffs from reads r)""")
def diffs_frac(spark, sf_dir):
    share = Q.difference_count(F.col("s0"), F.col("gseq")) / F.length("gseq")
    return D.reads(spark, sf_dir).select("name1", "gseq", F.round(share, 6).alias("diffs"))


@_query("""with r as (select k family, cast('0x' || substr(md5(name1 || gseq), 1, 12) as bigint) as row, barcode, name1 as name, gseq seq, s0 from reads),
n as (select *, row_number() over (partition by family order by row) rn from r),
c as (select family, row, rn, barcode, name, seq, p, substr(s0, p, 1) x, substr(seq, p, 1) y from n, (select unnest(range(1, 33)) p)),
g as (select *, coalesce(lag(y = '-' or x = '-') over (partition by family order by rn, p), false) before from c),
b as (select family, row, rn, barcode, name, seq, (p - 1) // 4 bin, cast(count(*) filter (x <> y and ((x <> '-' and y <> '-') or not before)) as double) / 4 share from g group by all)
select family, row, barcode, name, seq, string_agg(cast(share as varchar), ',' order by bin) bins from b group by family, row, rn, barcode, name, seq""")
def diffs_binned(spark, sf_dir):
    number = F.conv(F.substr(F.md5(F.concat("name1", "gseq")), F.lit(1), F.lit(12)), 16, 10).cast("long")
    rows = D.reads(spark, sf_dir).select(
        F.col("k").alias("family"), number.alias("row"), "barcode", F.col("name1").alias("name"), F.col("gseq").alias("seq"), F.col("s0").alias("consensus")
    )
    return Q.differences_binned(rows, 8).withColumn("bins", F.array_join(F.col("bins").cast("array<string>"), ","))


@_query("""with h as (select distinct barcode, 0 half, substr(barcode, 1, 12) h from reads union all select distinct barcode, 1, substr(barcode, 13) from reads),
k as (select distinct half, substr(h, o + 1, 8) kmer, barcode from h, (select unnest(range(0, 3)) o))
select half, kmer, string_agg(barcode, ',' order by barcode) barcodes, count(*) n from k group by half, kmer""")
def kmer_sets(spark, sf_dir):
    rows = Q.kmer_sets(D.reads(spark, sf_dir), 8, 2)
    return rows.select("half", "kmer", F.array_join("barcodes", ",").alias("barcodes"), F.size("barcodes").cast("long").alias("n"))


@_query()
def fuzzy_match(spark, sf_dir):
    return Q.fuzzy_groups(Q.kmer_members(D.noisy_families(spark, sf_dir), 10)).withColumn("similarity", F.round("similarity", 6))


@_query()
def strand_votes(spark, sf_dir):
    rows = D.reads(spark, sf_dir).select("name1", F.col("s0"), F.col("seq1").alias("seq"))
    return Q.strand_votes(rows, ["ACGTACGTAC", "TTGACCATGA"], 0.6).select("name1", "seq", "strand")


_GRID = """with g as (select distinct l_linenumber c, cast(l_quantity as int) n from lineitem where l_quantity >= 2),
i as (select c, n, cast(x as int) x from g, (select unnest(range(1, 26)) x) where x <= n // 2),
s as (select c, n, x, (select sum(pow(2.0, j) * pow(pow(2.0, -j), x) * pow(1 - pow(2.0, -j), n - x)) from (select unnest(range(1, 8)) j) where j <= c) a from (select c, n, cast(y as int) x from g, (select unnest(range(1, 51)) y) where y < n)),
z as (select c, n, x, a * exp(lgamma(n + 1.0) - lgamma(x + 1.0) - lgamma(n - x + 1.0)) a from s),
t2 as (select c, n, sum(a) whole from z group by c, n)"""


@_query(_GRID + """ select i.c k, i.n, i.x, round((z1.a + case when 2 * i.x = i.n then 0 else z2.a end) / whole, 7) p
from i join z z1 on z1.c = i.c and z1.n = i.n and z1.x = i.x join z z2 on z2.c = i.c and z2.n = i.n and z2.x = i.n - i.x join t2 on t2.c = i.c and t2.n = i.n""")
def pcr_maf(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity >= 2").select(F.col("l_linenumber").alias("k"), F.col("l_quantity").cast("int").alias("n")).distinct()
    grid = rows.select("k", "n", F.explode(F.sequence(F.lit(1), F.floor(F.col("n") / 2).cast("int"))).alias("x"))
    return Q.minor_alleles(grid).withColumn("p", F.round("p", 7))


_FREQ = """with o as (select barcode, ord, cast(count(*) as int) famsize, cast(count(distinct seq1) - 1 as int) errors from reads group by barcode, ord),
n as (select famsize, count(*) total from o group by famsize), c as (select famsize, errors x, count(*) m from o group by 1, 2),
f as (select n.famsize, n.total, x.x, coalesce(c.m, 0) / n.total freq from n join (select cast(unnest(range(1, 20)) as int) x) x on x.x <= n.famsize // 2 left join c on c.famsize = n.famsize and c.x = x.x)"""


def _chi_square(spark, sf_dir):
    fam = D.reads(spark, sf_dir).groupBy("barcode", "order").agg(F.count("*").cast("int").alias("famsize"), (F.countDistinct("seq1") - 1).cast("int").alias("errors"))
    expected = fam.select("famsize").distinct().select("famsize", F.explode(F.sequence(F.lit(1), F.greatest(F.floor(F.col("famsize") / 2).cast("int"), F.lit(1)))).alias("x"))
    expected = expected.select("famsize", "x", (F.lit(0.5) / F.col("x")).alias("prob"))
    return Q.chi_square(fam.select("famsize", "errors"), expected)


@_query(_FREQ + """
select famsize, total, round(sum(pow(freq - 0.5 / x, 2) / (0.5 / x)), 6) statistic from f where total >= 20 group by famsize, total having count(*) > 1""")
def chi_stat(spark, sf_dir):
    return _chi_square(spark, sf_dir).select("famsize", "total", F.round("statistic", 6).alias("statistic"))


@_query(_FREQ + """, st as (select famsize, total, sum(pow(freq - 0.5 / x, 2) / (0.5 / x)) / 2 z, (count(*) - 1) / 2 a from f where total >= 20 group by famsize, total having count(*) > 1)
select famsize, total, round(1 - sum(case when z > 0 then exp((a + k) * ln(greatest(z, 1e-300)) - z - lgamma(a + k + 1)) else 0 end), 7) p_value
from st, (select unnest(range(0, 500)) k) group by famsize, total""")
def chi_test(spark, sf_dir):
    """P-values of the chi-square test; the SQL adds up the series of the lower incomplete gamma function."""
    return _chi_square(spark, sf_dir).select("famsize", "total", F.round("p_value", 7).alias("p_value"))


# ---- alignment and simulation


@_query()
def sw_align(spark, sf_dir):
    """Both strands' first reads of each barcode aligned."""
    fam = D.reads(spark, sf_dir)
    one = fam.groupBy("barcode").agg(F.min(F.when(F.col("order") == "ab", F.col("seq1"))).alias("t"), F.min(F.when(F.col("order") == "ba", F.col("seq1"))).alias("q"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = align_pairs(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.string()] * 2 + [pa.int32()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["barcode", *names])

    names = [f.split(":")[0] for f in ALIGNMENT_TYPE[7:-1].split(",")]
    return one.where("t is not null and q is not null").mapInArrow(run, "barcode string, " + ALIGNMENT_TYPE[7:-1].replace(":", " "))


_NEAR_PAIRS = "select name1, case when sk % 2 = 0 then s0 else replace(gseq, '-', '') end t, case when sk % 2 = 0 then replace(gseq, '-', '') else s0 end q from reads"
_SHIFT = "list_min(list_filter(range(1, {n} - {i}), lambda k: least(5, {n} - {i} - k, {m} - {j}) >= 3 and substr({a}, {i} + k + 1, least(5, {n} - {i} - k, {m} - {j})) = substr({b}, {j} + 1, least(5, {n} - {i} - k, {m} - {j}))))"
_SHIFTS = ", ".join(
    f"case when not same then {_SHIFT.format(**use)} end {name}"
    for name, use in (("kt", dict(a="t", b="q", n="length(t)", m="length(q)", i="i", j="j")), ("kq", dict(a="q", b="t", n="length(q)", m="length(t)", i="j", j="i")))
)


@_query(f"""with p as (select row_number() over () id, * from ({_NEAR_PAIRS})),
walk as (select id, t, q, cast(0 as bigint) i, cast(0 as bigint) j, '' x, '' y, cast(0 as bigint) n_gaps from p
  union all select id, t, q, i + case way when 'both' then 1 when 'target' then kt else 0 end, j + case way when 'both' then 1 when 'query' then kq else 0 end,
    x || case way when 'both' then substr(t, i + 1, 1) when 'target' then substr(t, i + 1, kt) else repeat('-', kq) end,
    y || case way when 'both' then substr(q, j + 1, 1) when 'target' then repeat('-', kt) else substr(q, j + 1, kq) end, n_gaps + cast(way <> 'both' as bigint)
  from (select *, case when same or coalesce(kt, kq) is null then 'both' when kq is null or kt <= kq then 'target' else 'query' end way
    from (select *, {_SHIFTS} from (select *, substr(t, i + 1, 1) = substr(q, j + 1, 1) same from walk where i < length(t) and j < length(q))))),
e as (select id, x || substr(t, i + 1) x, y || substr(q, j + 1) y, n_gaps from walk where i >= length(t) or j >= length(q))
select name1, rpad(x, cast(greatest(length(x), length(y)) as int), '-') target, rpad(y, cast(greatest(length(x), length(y)) as int), '-') query, n_gaps,
  len(list_filter(range(1, least(length(x), length(y)) + 1), lambda k: substr(x, k, 1) = substr(y, k, 1))) matches from e join p using (id)""")
def near_align(spark, sf_dir):
    """Each read, less its gap, beside its fragment; every other pair the other way round."""
    pairs = D.view(spark, sf_dir, _NEAR_PAIRS)
    return pairs.select("name1", near_align_column("t", "q").alias("a")).select("name1", "a.*")


def _simulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fragment for every fifty orders, at least 50, from a fixed reference of 4,000 bases; no other table is read."""
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    reference = "".join(f"{i * 2654435761 % 4**8:08d}".translate(str.maketrans("0123456789", "ACGTACGTAC")) for i in range(500))
    return I.simulate(spark, reference, n_frags=max(50, n // 50), frag_len=120, read_len=60, cycles=12, seed=42)


@_query()
def simulate(spark, sf_dir):
    return _simulated(spark, sf_dir).select("frag_id", "read", "strand", "barcode1", "barcode2", "name1", "seq1", "name2", "seq2")


@_query()
def sim_check(spark, sf_dir):
    """Simulated reads through families, alignment, duplex calls and comparison with their fragments."""
    reads = materialise(_simulated(spark, sf_dir), "simulated")
    fam = materialise(B.make_families(reads), "families")
    called = C.duplex(M.align_families(fam), min_reads=2)
    out = I.check_consensus(I.label_consensus(called, fam), reads)
    return out.withColumn("n_reads", F.array_join(F.col("n_reads").cast("array<string>"), "-"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
