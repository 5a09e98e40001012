from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from ionloom.plans import metaproteomics
from ionloom.sources import sinks, text_formats
from ionloom.streaming import tags


def put(folder, name, text):
    path = folder / name
    (gzip.open(path, "wt") if name.endswith(".gz") else path.open("w")).write(text)
    return str(path)


def test_fasta_round_trip(spark, tmp_path):
    text = ">a first one\r\nMKV\nLLA\n>b\nGG\n>c x OS=Y\n\n"
    for name in ("x.fasta", "y.fasta.gz"):
        got = text_formats.read_fasta(spark, put(tmp_path, name, text))
        assert [tuple(r) for r in got.collect()] == [("a", "a first one", "MKVLLA"), ("b", "b", "GG"), ("c", "c x OS=Y", "")]
    sinks.write_fasta(got.where("seq <> ''"), f"{tmp_path}/out", without="X")
    assert sorted(map(tuple, text_formats.read_fasta(spark, f"{tmp_path}/out").collect())) == [("a", "a first one", "MKVLLA"), ("b", "b", "GG")]
    orf = text_formats.fasta_table(spark, put(tmp_path, "o.fasta", ">asm_c|asm_c_recno_1.0|(+)4:12 d\nGTGAAATAG\n"), 1).first()
    assert (orf.contig, orf.strand, orf.start, orf.end, orf.translation) == ("asm_c", "+", 4, 12, "MK")
    sinks.write_by_group(got.withColumn("scan", F.lit(1)), f"{tmp_path}/g", "scan", 3)
    assert text_formats.read_fasta(spark, f"{tmp_path}/g").count() == 3


def test_delimited(spark, tmp_path):
    path = put(tmp_path, "a.txt", "x;y\n1;b\n2;c\n")
    df = text_formats.read_delimited(spark, path, "x int, y string", with_file=True)
    assert [tuple(r) for r in df.collect()] == [(1, "b", "a.txt"), (2, "c", "a.txt")]
    assert text_formats.scan_keys(df, spark.createDataFrame([(2,), (2,)], "x int"), "x").count() == 1


def test_features_variants_alignments(spark, tmp_path):
    gff = text_formats.read_gff3(spark, put(tmp_path, "f.gff3", "##gff-version 3\nc1\ts\tgene\t5\t9\t.\t+\t.\tID=g1;Name=x\nc1\ts\tCDS\t6\t8\t.\t-\t0\tParent=g1\n##FASTA\n>c1\nACGT\n"))
    rows = gff.collect()
    assert [(r.type, r.start, r.attributes) for r in rows] == [("gene", 5, {"ID": "g1", "Name": "x"}), ("CDS", 6, {"Parent": "g1"})]
    sinks.write_gff3(gff, f"{tmp_path}/gff")
    assert [r.value for r in spark.read.text(f"{tmp_path}/gff").collect()] == ["c1\ts\tgene\t5\t9\t.\t+\t.\tID=g1;Name=x;", "c1\ts\tCDS\t6\t8\t.\t-\t0\tParent=g1;"]
    assert sorted((r.track, r.type) for r in sinks.split_by_type(gff).collect()) == [("CDS", "CDS"), ("CDS", "gene"), ("gene", "gene")]
    vcf = text_formats.read_vcf(spark, put(tmp_path, "v.vcf", "##x\n#CHROM\tPOS\tID\tREF\tALT\nc1\t7\t.\tA\tG,T\n")).first()
    assert (vcf.contig, vcf.pos, vcf.ref, vcf.alts) == ("c1", 7, "A", ["G", "T"])
    sam = text_formats.read_sam(spark, put(tmp_path, "s.sam", "@HD\nr1\t16\tc1\t5\t60\t3M1D2M\t*\t0\t0\tACGTA\tI\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tI\n")).collect()
    assert (sam[0].strand, sam[0].start, sam[0].end) == ("-", 5, 10) and sam[1].reference is None
    domains = text_formats.read_domains(spark, put(tmp_path, "d.tsv", "P1\tm\t9\tA\tS\t-\t1\t5\t-\tT\td\tIPR1\tx\tGO:1|GO:2\t-\n")).first()
    assert domains.go == ["GO:1", "GO:2"] and domains.pathways is None and domains.score is None


def test_tag_formats(spark, tmp_path):
    head = "H\n" * 25
    direct = text_formats.read_direct_tags(spark, put(tmp_path, "a.tags", head + "S\t12\tx\nT\tAB0\t10.12345\t0\nT\tCC\t0\t3.5\nS\t13\nT\tDD\t1\t2\n"), "s1").collect()
    assert [(r.scanid, r.sequence, r.ngap, r.tag) for r in direct] == [("s1.12", "ABO", 10.1235, "10.1235,ABO"), ("s1.12", "CC", 0.0, "CC,3.5"), ("s1.13", "DD", 1.0, "1.0,DD,2.0")]
    novor = text_formats.read_novor(spark, put(tmp_path, "n.csv", "scanNum,peptide\n 7, AM(O)K[x]\n"), "s1").first()
    assert (novor.scanid, novor.sequence, novor.tag) == ("s1.7", "AMK", "AMK")
    block = ">> 0 4 title\n#Index\tRnkScr\n0\t9.1\t5\t100.0\t0.0\t500\t2\tPEPT\n>> 0 5 t\n# No solutions found.\n"
    pep = text_formats.read_pepnovo(spark, put(tmp_path, "p.out", block), "s1").collect()
    assert [(r.scanid, r.sequence, r.ngap, r.tag, r["rank"]) for r in pep] == [("s1.4", "PEPT", 100.0, "100.0,PEPT", 0)]
    mapped = text_formats.read_mapped_tags(spark, put(tmp_path, "m.csv", "10.1,ABC,2.0,PEPK,P1,4\nABC,PEPK,P2,1\n")).collect()
    assert [tuple(r) for r in mapped] == [("10.1,ABC,2.0", "PEPK", "P1", 4), ("ABC", "PEPK", "P2", 1)]


def test_xml_sources(spark, tmp_path):
    hsp = lambda n, s: f"<Hsp><Hsp_num>{n}</Hsp_num><Hsp_score>{s}</Hsp_score><Hsp_evalue>1e-5</Hsp_evalue><Hsp_query-from>1</Hsp_query-from><Hsp_align-len>4</Hsp_align-len></Hsp>"
    blast = f"<B><Iteration><Iteration_query-def>q1</Iteration_query-def><Iteration_query-len>9</Iteration_query-len><Iteration_hits><Hit><Hit_def>s1</Hit_def><Hit_hsps>{hsp(1, 7)}{hsp(2, 5)}</Hit_hsps></Hit></Iteration_hits></Iteration></B>"
    rows = text_formats.read_blast_xml(spark, put(tmp_path, "b.xml", blast)).collect()
    assert [(r.query, r.subject, r.score, r.evalue, r.align_length) for r in rows] == [("q1", "s1", 7.0, 1e-5, 4), ("q1", "s1", 5.0, 1e-5, 4)]
    ident = '<M><SpectrumIdentificationResult spectrumID="s=1"><SpectrumIdentificationItem rank="1" chargeState="2" experimentalMassToCharge="500.5" peptide_ref="p1" passThreshold="true"/></SpectrumIdentificationResult></M>'
    psm = text_formats.read_mzidentml(spark, put(tmp_path, "i.mzid", ident)).first()
    assert (psm.spectrum, psm["rank"], psm.charge, psm.mz, psm.passes) == ("s=1", 1, 2, 500.5, True)


def test_long_tables_and_maps(spark):
    wide = spark.createDataFrame([(1, 5.0, 0.0, 2.0)], "id int, `Intensity a` double, `Intensity b` double, `iBAQ a` double")
    long = text_formats.unpivot_measures(wide, "id", {"intensity": "Intensity ", "ibaq": "iBAQ "})
    assert sorted(map(tuple, long.collect()), key=str) == [(1, "a", "ibaq", 2.0), (1, "a", "intensity", 5.0), (1, "b", "intensity", None)]
    back = sinks.wide_table(long.where("measure = 'intensity'"), "id", "sample", "value", ["a", "b"], "Intensity ")
    assert back.columns == ["id", "Intensity a", "Intensity b"]
    triples = spark.createDataFrame([("P", "GO", "2"), ("P", "GO", "1"), ("P", "KO", "x")], "acc string, name string, value string")
    assert text_formats.id_maps(triples).first().names == {"GO": ["1", "2"], "KO": ["x"]}
    assert spark.range(1).select(sinks.exported_list(F.array(F.lit("b"), F.lit("a"), F.lit("b"))).alias("x")).first().x == "a;b"


def test_wiggle_and_replaced_files(spark, tmp_path):
    runs = spark.createDataFrame([("c1", 5, 6, 3), ("c1", 9, 9, 1)], "contig string, start long, end long, value long")
    sinks.write_wiggle(runs, f"{tmp_path}/wig")
    assert [r.value for r in spark.read.text(f"{tmp_path}/wig/contig=c1").collect()] == ["variableStep chrom=c1", "5 3", "6 3", "9 1"]
    rows = lambda f, v: spark.createDataFrame([(f, v)], "file string, v int")
    for f, v in (("a", 1), ("b", 2), ("a", 3)):
        sinks.replace_files(rows(f, v), f"{tmp_path}/t")
    assert sorted((r.file, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [("a", 3), ("b", 2)]


def test_filtration_plan(spark):
    proteins = spark.createDataFrame([("P1", "MAGKLLLRPEPTIDEK", "P1 x OS=One"), ("P2", "AGKLLLK", "P2 y OS=Two"), ("P3", "GGGG", "P3 z")], "acc string, seq string, description string")
    mapped = spark.createDataFrame([("t1", "AGK", "P1", 2), ("t1", "AGK", "P2", 1), ("t2", "LLLRPEPTIDEK", "P1", 5), ("t3", "LLRPEP", "P1", 6)], "tag string, peptide string, accession string, position int")
    hits = spark.createDataFrame([("t1", "s", "s.1"), ("t2", "s", "s.2"), ("t3", "s", "s.3")], "tag string, sample string, scanid string")
    valid = metaproteomics.valid_hits(mapped, proteins, metaproteomics.FiltrationConfig())
    assert sorted((r.tag, r.accession) for r in valid.collect()) == [("t1", "P1"), ("t1", "P2"), ("t2", "P1")]
    ranked = metaproteomics.filter_database(hits, mapped, proteins).orderBy("rank").collect()
    assert [r.acc for r in ranked][0] in ("P1", "P2") and {r.acc for r in ranked} <= {"P1", "P2"} and sum(r.new_scans for r in ranked) == 2


def test_search_result_plan(spark):
    peptides = spark.createDataFrame([(i, f"PEPI{i}", "+" if i == 9 else None, "1") for i in range(10)], "id int, sequence string, reverse string, group_ids string")
    design = spark.createDataFrame([(f"s{k}", f"r{k}", "+" if k == 6 else "-", "a" if k < 3 else "b") for k in range(7)], "sample string, rename string, exclude string, level string")
    measures = spark.createDataFrame([(i, f"s{k}", float(100 + 7 * i + k + (300 if i == 2 and k < 3 else 0))) for i in range(10) for k in range(7)], "id int, sample string, value double")
    lineages = spark.createDataFrame([(f"PEPL{i}", "bacteria", f"sp{i % 2}") for i in range(10)], "sequence string, phylum string, species string")
    out = metaproteomics.summarise(metaproteomics.SearchResults(peptides, measures, design, lineages, ["phylum", "species"]), "a", "b")
    assert out["targets"].count() == 9 and out["decoys"].count() == 1 and out["normalised"].count() == 54
    assert {(r["rank"], r.taxon): r.peptide_count for r in out["taxa"].collect()} == {("phylum", "bacteria"): 9, ("species", "sp0"): 5, ("species", "sp1"): 4}
    best = min(out["differential"].collect(), key=lambda r: r.p)
    assert best.id == 2 and best.log_fc > 0.5


def test_proteogenomic_plan(spark):
    gene = "ATG" + "GCTAAAGGTCGT" * 4 + "TAA"
    out = metaproteomics.proteogenomics(spark.createDataFrame([("c", "CC" + gene + "GGG")], "contig string, seq string"), spark.createDataFrame([("AKGRAK",), ("MAKGR",), ("ZZZ",)], "peptide string"), 5)
    mapped = {(r.peptide, r.start): (r.strand, r.end, r.start_type) for r in out["mapped"].collect() if r.strand == "+"}
    assert mapped["MAKGR", 3] == ("+", 17, "annotated start") and len([k for k in mapped if k[0] == "AKGRAK"]) == 3
    assert "MAKGR" in {r.peptide for r in out["specific"].collect()}
    sites = spark.createDataFrame([("x", "P", 1), ("y", "P", 1), ("x", "P", 5)], "strain string, protein string, position int")
    assert [tuple(r) for r in metaproteomics.map_clusters(sites).collect()] == [("x", "y", "P:5")]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda f, s: f'{{"file": "{f}", "acc": "P", "sample": "a", "scan": "{s}"}}\n'
    for name, text in (("1.json", row("f1", "x") + row("f1", "y")), ("2.json", row("f2", "z"))):
        put(tmp_path / "in", name, text)
        tags.follow_evidence(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    put(tmp_path / "in", "3.json", row("f1", "only"))
    tags.follow_evidence(spark, f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert sorted((r.file, r.scan) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [("f1", "only"), ("f2", "z")]
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert tags.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()
