"""The driver's tables seen as the engine's relations, and the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluvia.functions import scalars
from fluvia.operators import tree, windows


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def read_assignment(spark: SparkSession, d: str) -> DataFrame:
    return assigned(table(spark, d, "lineitem"))


def assigned(lineitem: DataFrame) -> DataFrame:
    u = F.col("l_returnflag") == "R"
    return lineitem.select(
        F.col("l_linestatus").alias("sample_id"), ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("long").alias("batch_id"), F.when(u, "U").otherwise("C").alias("status"),
        F.concat_ws("_", "l_orderkey", "l_linenumber").alias("read_id"), F.when(u, "0").otherwise((F.col("l_suppkey") + 1000).cast("string")).alias("taxid"), (F.col("l_quantity") * 100).cast("long").alias("length"),
    )


RA = """ra AS (SELECT l_linestatus AS sample_id, ((year(l_shipdate) - 1995) * 12 + month(l_shipdate))::BIGINT AS batch_id,
  CASE WHEN l_returnflag = 'R' THEN 'U' ELSE 'C' END AS status, l_orderkey || '_' || l_linenumber AS read_id,
  CASE WHEN l_returnflag = 'R' THEN '0' ELSE (1000 + l_suppkey)::VARCHAR END AS taxid, (l_quantity * 100)::BIGINT AS length FROM lineitem)"""


def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.col(c) if isinstance(c, str) else c.cast("string")
    part = lambda name, taxid, parent, rank, label: table(spark, d, name).select(s(taxid).alias("taxid"), s(parent).alias("parent"), F.lit(rank).alias("rank"), F.col(label).alias("name"))
    root = spark.range(1).select(F.lit("1").alias("taxid"), F.lit(None).cast("string").alias("parent"), F.lit("R").alias("rank"), F.lit("root").alias("name"))
    return (
        root.unionByName(part("region", F.col("r_regionkey") + 10, F.lit(1), "D", "r_name"))
        .unionByName(part("nation", F.col("n_nationkey") + 100, F.col("n_regionkey") + 10, "F", "n_name"))
        .unionByName(part("supplier", F.col("s_suppkey") + 1000, F.col("s_nationkey") + 100, "S", "s_name"))
    )


TAX = """tax AS (SELECT '1' AS taxid, NULL::VARCHAR AS parent, 'R' AS rank, 'root' AS name UNION ALL SELECT (10 + r_regionkey)::VARCHAR, '1', 'D', r_name FROM region
  UNION ALL SELECT (100 + n_nationkey)::VARCHAR, (10 + n_regionkey)::VARCHAR, 'F', n_name FROM nation
  UNION ALL SELECT (1000 + s_suppkey)::VARCHAR, (100 + s_nationkey)::VARCHAR, 'S', s_name FROM supplier)"""


def genomes(spark: SparkSession, d: str) -> DataFrame:
    taxid = (F.col("s_suppkey") + 1000).cast("string")
    return table(spark, d, "supplier").select(taxid.alias("taxid"), F.concat(F.lit("/genomes/"), taxid, F.lit(".fa")).alias("path"))


GEN = """gen AS (SELECT (1000 + s_suppkey)::VARCHAR AS taxid, '/genomes/' || (1000 + s_suppkey) || '.fa' AS path FROM supplier)"""


def alignments(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    start = (c("l_partkey") % 1900) * 50
    return table(spark, d, "lineitem").select(
        c("l_linestatus").alias("sample_id"), ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("long").alias("batch_id"), (c("l_suppkey") + 1000).cast("string").alias("taxid"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("qname"),
        F.concat(F.lit("contig"), c("l_partkey") % 7).alias("tname"), F.lit(100_000).cast("long").alias("tlen"), start.cast("long").alias("tstart"), (start + c("l_quantity").cast("long") * 10).cast("long").alias("tend"),
        (c("l_linenumber") * 10 - (c("l_suppkey") % 8) * 10).cast("long").alias("mapq"), (F.lit(100.0) - F.round(c("l_discount") * 100) - (c("l_suppkey") % 10) * 2).alias("identity"),
    )


ALN = """aln AS (SELECT l_linestatus AS sample_id, ((year(l_shipdate) - 1995) * 12 + month(l_shipdate))::BIGINT AS batch_id, (1000 + l_suppkey)::VARCHAR AS taxid, l_orderkey || '_' || l_linenumber AS qname,
  'contig' || (l_partkey % 7) AS tname, 100000::BIGINT AS tlen, ((l_partkey % 1900) * 50)::BIGINT AS tstart, ((l_partkey % 1900) * 50 + l_quantity::BIGINT * 10)::BIGINT AS tend,
  (l_linenumber * 10 - (l_suppkey % 8) * 10)::BIGINT AS mapq, 100.0::DOUBLE - round(l_discount * 100) - (l_suppkey % 10) * 2 AS identity FROM lineitem)"""


def mappings(spark: SparkSession, d: str) -> DataFrame:
    """Alignments with their queries' coordinates, contigs of several lengths and both strands."""
    c, line = F.col, table(spark, d, "lineitem")
    contig, size = c("l_partkey") % 7, c("l_quantity").cast("long") * 10
    lo, hi = c("l_linenumber").cast("long") * 2, c("l_linenumber").cast("long") * 2 + F.floor(size * (10 - c("l_linenumber")) / 10)
    own = {"tlen": 90_000 + (contig * 3 % 7) * 4_000, "qlen": 1024 * (1 + c("l_partkey") % 2), "qstart": F.when(c("l_suppkey") % 2 == 0, hi).otherwise(lo), "qend": F.when(c("l_suppkey") % 2 == 0, lo).otherwise(hi)}
    names = {"sample_id": c("l_linestatus"), "taxid": (c("l_suppkey") + 1000).cast("string"), "qname": F.concat_ws("_", "l_orderkey", "l_linenumber"), "tname": F.concat(F.lit("contig"), contig)}
    start = (c("l_partkey") % 1900) * 50
    rest = {"tstart": start.cast("long"), "tend": (start + size).cast("long"), "mapq": (c("l_linenumber") * 10 - (c("l_suppkey") % 8) * 10).cast("long"), "identity": F.lit(100.0) - F.round(c("l_discount") * 100) - (c("l_suppkey") % 10) * 2}
    hit = {"qcovs": (50 + c("l_quantity")).cast("double"), "evalue": c("l_linenumber") * 1e-12}
    return line.select(*(v.cast("long").alias(k) for k, v in own.items()), *(v.alias(k) for k, v in {**names, **rest, **hit}.items()))


MAP = """mp AS (SELECT (90000 + ((l_partkey % 7) * 3 % 7) * 4000)::BIGINT AS tlen, (1024 * (1 + l_partkey % 2))::BIGINT AS qlen,
  CASE WHEN l_suppkey % 2 = 0 THEN hi ELSE lo END AS qstart, CASE WHEN l_suppkey % 2 = 0 THEN lo ELSE hi END AS qend,
  l_linestatus AS sample_id, (1000 + l_suppkey)::VARCHAR AS taxid, l_orderkey || '_' || l_linenumber AS qname, 'contig' || (l_partkey % 7) AS tname,
  ((l_partkey % 1900) * 50)::BIGINT AS tstart, ((l_partkey % 1900) * 50 + l_quantity::BIGINT * 10)::BIGINT AS tend, (l_linenumber * 10 - (l_suppkey % 8) * 10)::BIGINT AS mapq,
  100.0::DOUBLE - round(l_discount * 100) - (l_suppkey % 10) * 2 AS identity, (50 + l_quantity)::DOUBLE AS qcovs, l_linenumber * 1e-12::DOUBLE AS evalue
  FROM (SELECT *, l_linenumber::BIGINT * 2 AS lo, l_linenumber::BIGINT * 2 + (l_quantity::BIGINT * 10 * (10 - l_linenumber)) // 10 AS hi FROM lineitem))"""
#: A total order of a query's alignments, up to equal rows.
ALN_ORDER = ["tstart", "tend", "identity", "mapq", "tname"]


def files(spark: SparkSession, d: str) -> DataFrame:
    """File metadata in arrival order, ten to a batch."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    e = windows.ordinal(e, "event_id", "arrival")
    size, packed = F.floor(F.col("value") * 1_000_000).cast("long"), F.col("user_id") % 2 == 0
    return e.select(
        "event_id", "arrival", F.floor(F.col("arrival") / 10).cast("long").alias("batch_id"), size.alias("file_size"), packed.alias("is_compressed"), scalars.estimated_reads(size, packed).alias("estimated_reads"),
        ((F.col("event_id") % 977) * 1000).cast("long").alias("file_age_ms"), (F.col("event_id") % 200).cast("long").alias("priority_score"), F.col("event_type").alias("watch_dir"), F.col("user_id").cast("string").alias("sample_id"),
    )


FM = """ev AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS arrival, floor(value * 1000000)::BIGINT AS sz FROM events),
fm AS (SELECT event_id, arrival, (arrival // 10)::BIGINT AS batch_id, sz AS file_size, user_id % 2 = 0 AS is_compressed,
  floor(CASE WHEN user_id % 2 = 0 THEN sz * 4 ELSE sz END / 4000)::BIGINT AS estimated_reads, ((event_id % 977) * 1000)::BIGINT AS file_age_ms,
  (event_id % 200)::BIGINT AS priority_score, event_type AS watch_dir, user_id::VARCHAR AS sample_id FROM ev)"""


def reads(spark: SparkSession, d: str) -> DataFrame:
    s = F.regexp_replace("text", "[^!-~]", "")
    return table(spark, d, "documents").select(F.col("source").alias("sample_id"), F.col("lang").alias("batch"), F.col("doc_id").cast("string").alias("read_id"), s.alias("sequence"), s.alias("quality"))


READS = """reads AS (SELECT source AS sample_id, lang AS batch, doc_id::VARCHAR AS read_id, regexp_replace(text, '[^!-~]', '', 'g') AS sequence, regexp_replace(text, '[^!-~]', '', 'g') AS quality FROM documents)"""


def read_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of reads per (sample, batch); the rates are whole numbers of ten-thousandths over one division."""
    n = F.length("sequence")
    g = F.length("sequence") - F.length(F.translate("sequence", "gcGC", ""))
    return reads(spark, d).groupBy("sample_id", "batch").agg(
        F.count("*").alias("num_seqs"), F.sum(n).alias("sum_len"), F.min(n).cast("long").alias("min_len"), F.max(n).cast("long").alias("max_len"), F.floor(F.sum(g) * 100 / F.sum(n)).cast("double").alias("gc"),
        (F.count("*") % 100).cast("double").alias("q20"), (F.sum(n) % 50).cast("double").alias("q30"), (F.max(n) % 40).cast("double").alias("avg_qual"),
    )


SKS = """sks AS (SELECT sample_id, batch, count(*) AS num_seqs, sum(length(sequence))::BIGINT AS sum_len, min(length(sequence))::BIGINT AS min_len, max(length(sequence))::BIGINT AS max_len,
  floor(sum(length(regexp_replace(sequence, '[^gcGC]', '', 'g'))) * 100 / sum(length(sequence)))::DOUBLE AS gc, (count(*) % 100)::DOUBLE AS q20,
  (sum(length(sequence)) % 50)::DOUBLE AS q30, (max(length(sequence)) % 40)::DOUBLE AS avg_qual FROM reads GROUP BY ALL)"""


def contigs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_brand").alias("sample_id"), F.col("p_partkey").cast("string").alias("name"), (F.col("p_partkey") % 997 + 1).cast("long").alias("length"), (F.col("p_size") % 7 == 0).alias("circular"))


CTG = """ctg AS (SELECT p_brand AS sample_id, p_partkey::VARCHAR AS name, (p_partkey % 997 + 1)::BIGINT AS length, p_size % 7 = 0 AS circular FROM part)"""


def direct_counts(spark: SparkSession, d: str) -> DataFrame:
    return read_assignment(spark, d).filter("status = 'C'").groupBy("sample_id", "taxid").agg(F.count("*").alias("reads"))


def report_rows(spark: SparkSession, d: str) -> DataFrame:
    """(sample_id, taxid, reads, cumul, rank, name, parent) with the unclassified row."""
    tax = taxonomy(spark, d)
    rows = tree.clade_counts(direct_counts(spark, d), tax, ["sample_id"]).join(tax, "taxid").select("sample_id", "taxid", "reads", "cumul", "rank", "name", "parent")
    other = read_assignment(spark, d).filter("status = 'U'").groupBy("sample_id").agg(F.count("*").alias("n"))
    return rows.unionByName(other.select("sample_id", F.lit("0").alias("taxid"), F.col("n").alias("reads"), F.col("n").alias("cumul"), F.lit("U").alias("rank"), F.lit("unclassified").alias("name"), F.lit(None).cast("string").alias("parent")))


def report(spark: SparkSession, d: str) -> DataFrame:
    """Reports in depth-first order, names indented."""
    return tree.indented(tree.depth_first(report_rows(spark, d), ["sample_id"]))


UP = f"""{RA}, {TAX},
up AS (SELECT taxid, taxid AS ancestor FROM tax UNION ALL SELECT u.taxid, t.parent FROM up u JOIN tax t ON t.taxid = u.ancestor WHERE t.parent IS NOT NULL),
direct AS (SELECT sample_id, taxid, count(*) AS reads FROM ra WHERE status = 'C' GROUP BY ALL),
cl AS (SELECT sample_id, ancestor AS taxid, sum(reads)::BIGINT AS cumul FROM direct JOIN up USING (taxid) GROUP BY ALL),
rep AS (SELECT cl.sample_id, cl.taxid, coalesce(direct.reads, 0) AS reads, cumul, tax.rank, tax.name, tax.parent FROM cl LEFT JOIN direct USING (sample_id, taxid) JOIN tax ON tax.taxid = cl.taxid
  UNION ALL SELECT sample_id, '0', count(*), count(*), 'U', 'unclassified', NULL FROM ra WHERE status = 'U' GROUP BY sample_id)"""
KR = f"""{UP},
walk AS (SELECT sample_id, taxid, 0 AS depth, printf('%012d', 999999999999 - cumul) || taxid AS path FROM rep WHERE parent IS NULL
  UNION ALL SELECT r.sample_id, r.taxid, w.depth + 1, w.path || '/' || printf('%012d', 999999999999 - r.cumul) || r.taxid FROM walk w JOIN rep r ON r.parent = w.taxid AND r.sample_id = w.sample_id),
kr AS (SELECT rep.sample_id, rep.taxid, reads, cumul, rank, repeat('  ', depth) || name AS name, parent, depth, (row_number() OVER (PARTITION BY rep.sample_id ORDER BY path))::INTEGER AS row_no FROM rep JOIN walk ON walk.sample_id = rep.sample_id AND walk.taxid = rep.taxid)"""


def batch_reports(spark: SparkSession, d: str) -> DataFrame:
    """Report rows of each sample's batches, in order of the taxid's number."""
    tax = taxonomy(spark, d)
    own = read_assignment(spark, d).filter("status = 'C'").groupBy("sample_id", "batch_id", "taxid").agg(F.count("*").alias("reads"))
    return tree.clade_counts(own, tax, ["sample_id", "batch_id"]).join(tax, "taxid").withColumn("row_no", F.col("taxid").cast("long"))


def paths(spark: SparkSession, d: str) -> DataFrame:
    """File paths of many shapes made from parts."""
    k = F.col("p_partkey")
    folder = F.when(k % 5 == 0, F.concat(F.lit("run/barcode"), (k % 120).cast("string"))).when(k % 5 == 1, F.lit("run/fastq_pass")).when(k % 5 == 2, F.lit("output")).when(k % 5 == 3, F.lit("deep/er/er")).otherwise(F.lit("flat"))
    name = F.when(k % 3 == 0, F.concat(F.lit("FAX_Barcode"), (k % 130).cast("string"), F.lit("_x"))).when(k % 3 == 1, F.concat(F.lit("sample-"), k.cast("string"))).otherwise(F.lit(".hidden"))
    suffix = F.when(k % 4 == 0, ".fastq").when(k % 4 == 1, ".fq.gz").when(k % 4 == 2, ".fastq.gz").otherwise(".txt")
    return table(spark, d, "part").select(k.alias("file_id"), F.concat(folder, F.lit("/"), name, suffix).alias("path"))


PATHS = """paths AS (SELECT p_partkey AS file_id, CASE p_partkey % 5 WHEN 0 THEN 'run/barcode' || (p_partkey % 120) WHEN 1 THEN 'run/fastq_pass' WHEN 2 THEN 'output' WHEN 3 THEN 'deep/er/er' ELSE 'flat' END
  || '/' || CASE p_partkey % 3 WHEN 0 THEN 'FAX_Barcode' || (p_partkey % 130) || '_x' WHEN 1 THEN 'sample-' || p_partkey ELSE '.hidden' END
  || CASE p_partkey % 4 WHEN 0 THEN '.fastq' WHEN 1 THEN '.fq.gz' WHEN 2 THEN '.fastq.gz' ELSE '.txt' END AS path FROM part)"""
