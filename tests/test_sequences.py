from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellstrand.functions import alignment as aln
from cellstrand.functions import sequence as seq
from cellstrand.operators import whitelist

quiet = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) and not isinstance(v, bool) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


def test_poly_t(spark):
    rows = {"TTTTA": 0, "TTTTTA": 5, "TTTTTTTTTTTT": 12, "ATTTTTT": 0, "": 0}
    got = spark.createDataFrame([(k,) for k in rows], "s string").select("s", seq.poly_t_length(F.col("s")).alias("n")).collect()
    assert {r.s: r.n for r in got} == rows


def test_before_adapter(spark):
    assert one(spark, seq.before(F.col("s"), F.lit(seq.ADAPTER)), s="ACG" + seq.ADAPTER + "TT") == 3
    assert one(spark, seq.before(F.col("s"), F.lit(seq.ADAPTER)), s="ACG" + seq.ADAPTER[:-1] + "G") == 3 + 17
    assert one(spark, seq.before(F.col("s"), F.lit("ACG")), s="ACGTT") == 0


def test_reverse_complement_and_pieces(spark):
    assert one(spark, seq.reverse_complement(F.col("s")), s="AACGTN") == "NACGTT"
    assert one(spark, seq.piece(F.col("s"), 2, 4), s="ACGT") == "GT"
    assert one(spark, seq.piece(F.col("s"), 2, 4), s="ACG") == "G"
    assert one(spark, seq.rest(F.col("s"), 9), s="ACG") == ""


def test_within_one(spark):
    for s, want in ((seq.CONSTANT_1, True), ("NAAGTTGATA", True), ("NNAGTTGATA", False), ("CAAGTTGAT", False), (None, False)):
        assert one(spark, seq.within_one(F.col("s").cast("string"), seq.CONSTANT_1), s=s) is want


def test_header(spark):
    assert one(spark, seq.header(F.col("n"), F.col("d")), n="x", d="r1 1:N:0") == "x r1 1:N:0"
    assert one(spark, seq.header(F.col("n"), F.col("d")), n="x", d="x 1:N:0") == "x 1:N:0"
    assert one(spark, seq.header(F.col("n"), F.col("d")), n="x", d="") == "x"


def neighbours(s):
    return {s[:k] + b + s[k + 1 :] for k in range(len(s)) for b in "ACGTN"}


@quiet
@given(st.lists(st.text("ACGTN", min_size=3, max_size=4), min_size=1, max_size=6), st.booleans())
def test_dictionary(spark, entries, dedup):
    count = Counter(v for s in (set(entries) if dedup else entries) for v in neighbours(s))
    wanted = {v: s for s in entries for v in neighbours(s) if count[v] == 1}
    got = whitelist.correction_dictionary(spark.createDataFrame([(s,) for s in entries], "s string"), "s", dedup)
    assert {r.variant: r.original for r in got.collect()} == wanted


def test_dictionary_size(spark):
    # lone 10-mers have 41 variants each; two at distance 1 share the five of the differing place, two at distance 2 share two
    for other, lost in (("TTTTTTTTTT", 0), ("AAAAAAAAAC", 5), ("AAAAAAAACC", 2)):
        rows = spark.createDataFrame([("AAAAAAAAAA",), (other,)], "s string")
        assert whitelist.correction_dictionary(rows, "s").count() == 82 - 2 * lost


def test_blocks(spark):
    def blocks(cigar):
        return [tuple(b) for b in one(spark, aln.blocks(F.col("p"), F.col("c")), p=10, c=cigar)]

    assert blocks("60M") == [(10, 70)]
    assert blocks("20M100N40M") == [(10, 30), (130, 170)]
    assert blocks("5S50M5I") == [(10, 60)]
    assert blocks("10M2D50M") == [(10, 20), (22, 72)]
    assert blocks("60=") == [] and blocks("*") == []
    assert one(spark, aln.reference_end(F.col("p"), F.col("c")), p=10, c="5S10M2D3I50M5N") == 77


def test_fragment_strand(spark):
    got = [one(spark, aln.fragment_strand(F.col("a"), F.col("b")), a=a, b=b) for a, b in ((True, False), (False, True), (True, True))]
    assert got == ["+", "-", "."]


def test_flags(spark):
    for flag, mapq, want in ((99, 30, True), (99, 29, False), (65, 60, False), (1024 + 3, 60, False), (2, 30, True)):
        assert one(spark, aln.well_mapped(F.col("f"), F.col("q")), f=flag, q=mapq) is want
