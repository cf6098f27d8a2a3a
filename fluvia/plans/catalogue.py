"""Named queries over the driver's tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fluvia.functions import scalars
from fluvia.operators import aggregates, joins, kmer, reads, tree, validation, windows
from fluvia.sources import sinks
from fluvia.streaming import batches

from . import adapters as A

FLAGSHIP = "validation_verdict"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# Reads assigned to taxa -------------------------------------------------------------------------------------------


@query(f"WITH {A.RA} SELECT sample_id, taxid, count(*) AS n FROM ra WHERE status = 'C' GROUP BY ALL")
def taxid_histogram(spark, d):
    return validation.taxid_histogram(A.read_assignment(spark, d))


@query(f"WITH {A.RA}, {A.GEN} SELECT sample_id, taxid, path, count(*) AS n FROM ra JOIN gen USING (taxid) WHERE status = 'C' GROUP BY ALL HAVING count(*) >= 5 UNION ALL SELECT 'unreadable', taxid, path, NULL FROM gen")
def gated_validation_tasks(spark, d):
    unreadable = spark.range(1).select(F.lit("unreadable").alias("sample_id"))
    return validation.gated_tasks(validation.taxid_histogram(A.read_assignment(spark, d)), A.genomes(spark, d), 5, unreadable)


@query(f"WITH {A.GEN} SELECT taxid, path FROM gen WHERE taxid IN ('1003', '1009', '1010')")
def selected_genomes(spark, d):
    return validation.select_genomes(A.genomes(spark, d), " 1003,1009 , 1010")


@query(f"WITH {A.RA} SELECT l_orderkey || '_' || l_linenumber AS read_id, l_partkey::VARCHAR AS sequence FROM lineitem WHERE l_orderkey || '_' || l_linenumber IN (SELECT read_id FROM ra WHERE status = 'C' AND taxid = '1007')")
def extract_reads_semi(spark, d):
    own = A.table(spark, d, "lineitem").select(F.concat_ws("_", "l_orderkey", "l_linenumber").alias("read_id"), F.col("l_partkey").cast("string").alias("sequence"))
    return validation.extract_reads(own, A.read_assignment(spark, d), "1007")


@query(f"WITH {A.RA} SELECT sample_id, taxid, count(*) AS extracted, (sum(count(*)) OVER (PARTITION BY sample_id))::BIGINT AS classified, count(*) / (sum(count(*)) OVER (PARTITION BY sample_id))::DOUBLE AS rate FROM ra WHERE status = 'C' GROUP BY sample_id, taxid")
def extraction_stats(spark, d):
    return validation.extraction_stats(A.read_assignment(spark, d))


@query(f"WITH {A.RA} SELECT sample_id, batch_id, count(*) AS total, count(*) FILTER (status = 'C') AS classified FROM ra GROUP BY ALL")
def batch_read_counts(spark, d):
    return aggregates.batch_counts(A.read_assignment(spark, d))


@query(f"WITH {A.RA}, f AS (SELECT sample_id, count(DISTINCT batch_id) AS found FROM ra GROUP BY 1) SELECT sample_id, coalesce(found, 0) AS found, coalesce(expected, 0)::BIGINT AS expected, coalesce(expected, 0) = 0 OR coalesce(found, 0) >= expected AS complete FROM f FULL JOIN (SELECT * FROM (VALUES ('F', 10), ('O', 500), ('X', 0), ('Y', 2)) v(sample_id, expected)) e USING (sample_id)")
def aggregation_completeness(spark, d):
    expected = spark.createDataFrame([("F", 10), ("O", 500), ("X", 0), ("Y", 2)], "sample_id string, expected long")
    return aggregates.completeness(A.read_assignment(spark, d), expected)


@query(f"WITH {A.RA} SELECT taxid, count(*) FILTER (sample_id = 'F') AS F, count(*) FILTER (sample_id = 'O') AS O FROM ra WHERE status = 'C' GROUP BY 1")
def taxon_wide_matrix(spark, d):
    return aggregates.wide_matrix(validation.taxid_histogram(A.read_assignment(spark, d)), ["F", "O"])


# Reports and trees ------------------------------------------------------------------------------------------------


@query(f"WITH RECURSIVE {A.UP} SELECT sample_id, taxid, reads, cumul FROM rep WHERE taxid <> '0'")
def clade_rollup(spark, d):
    return tree.clade_counts(A.direct_counts(spark, d), A.taxonomy(spark, d), ["sample_id"])


@query(f"WITH RECURSIVE {A.KR} SELECT sample_id, row_no, depth, taxid, name, reads, cumul FROM kr")
def kreport_depth_first(spark, d):
    return A.report(spark, d).select("sample_id", "row_no", "depth", "taxid", "name", "reads", "cumul")


@query(f"WITH RECURSIVE {A.KR} SELECT sample_id, row_no, taxid, parent FROM kr")
def kreport_parent_recovery(spark, d):
    return tree.recover_parents(A.report(spark, d).drop("parent"), ["sample_id"]).select("sample_id", "row_no", "taxid", "parent")


@query(f"WITH RECURSIVE {A.KR} SELECT sample_id, sum(reads)::BIGINT AS total, sum(CASE WHEN rank <> 'U' THEN reads ELSE 0 END)::BIGINT AS classified, sum(CASE WHEN rank = 'U' THEN reads ELSE 0 END)::BIGINT AS unclassified, sum(CASE WHEN rank <> 'U' THEN reads ELSE 0 END)::DOUBLE / sum(reads) AS rate FROM kr GROUP BY 1")
def classifier_stats_by_rank(spark, d):
    return aggregates.classifier_stats(A.report(spark, d))


@query(f"WITH RECURSIVE {A.KR} SELECT sample_id, max(cumul) FILTER (taxid = '1') AS classified, max(reads) FILTER (taxid = '0') AS unclassified, max(cumul) FILTER (taxid = '1') + max(reads) FILTER (taxid = '0') AS total, max(cumul) FILTER (taxid = '1') / (max(cumul) FILTER (taxid = '1') + max(reads) FILTER (taxid = '0'))::DOUBLE AS rate, count(*) AS unique_taxa FROM kr GROUP BY 1")
def report_stats(spark, d):
    return aggregates.report_stats(A.report(spark, d))


_MERGED = f"""{A.UP},
bd AS (SELECT sample_id, batch_id, taxid, count(*) AS reads FROM ra WHERE status = 'C' GROUP BY ALL),
bc AS (SELECT sample_id, batch_id, ancestor AS taxid, sum(reads) AS cumul FROM bd JOIN up USING (taxid) GROUP BY ALL),
mg AS (SELECT bc.sample_id, bc.taxid, coalesce(sum(bd.reads), 0)::BIGINT AS reads, sum(cumul)::BIGINT AS cumul, any_value(tax.rank) AS rank, any_value(tax.name) AS name, any_value(tax.parent) AS parent
  FROM bc LEFT JOIN bd USING (sample_id, batch_id, taxid) JOIN tax ON tax.taxid = bc.taxid GROUP BY 1, 2)"""


@query(f"WITH RECURSIVE {_MERGED} SELECT mg.*, cumul * 100.0::DOUBLE / (SELECT count(*) FROM ra WHERE ra.sample_id = mg.sample_id) AS pct FROM mg")
def cumulative_taxon_merge(spark, d):
    totals = A.read_assignment(spark, d).groupBy("sample_id").agg(F.count("*").alias("total"))
    return tree.percents(tree.merge_batches(A.batch_reports(spark, d)), totals)


@query(f"WITH RECURSIVE {A.KR}, m AS (SELECT sample_id, max(cumul) FILTER (taxid = '1') + max(cumul) FILTER (taxid = '0') AS n FROM kr GROUP BY 1) SELECT sample_id, row_no, taxid::BIGINT AS taxid, trim(name) AS name, rank, cumul AS reads_clade, reads AS reads_direct, cumul * 100.0::DOUBLE / n AS percent, coalesce(parent, '0')::BIGINT AS parent_taxid FROM kr JOIN m USING (sample_id)")
def canonical_classification(spark, d):
    rows = A.report(spark, d)
    n = rows.filter("taxid in ('0', '1')").groupBy("sample_id").agg(F.sum("cumul").alias("n"))
    return rows.join(n, "sample_id").select(
        "sample_id", "row_no", F.col("taxid").cast("long").alias("taxid"), F.trim("name").alias("name"), "rank", F.col("cumul").alias("reads_clade"), F.col("reads").alias("reads_direct"),
        (F.col("cumul") * 100.0 / F.col("n")).alias("percent"), F.coalesce("parent", F.lit("0")).cast("long").alias("parent_taxid"),
    )


@query(f"WITH RECURSIVE {A.KR} SELECT sample_id, taxid, trim(name) AS name, cumul FROM kr WHERE rank IN ('S', 'G') AND cumul >= 10 QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY cumul DESC, taxid) <= 10")
def top_species(spark, d):
    w = Window.partitionBy("sample_id").orderBy(F.desc("cumul"), "taxid")
    rows = A.report(spark, d).filter(F.col("rank").isin("S", "G") & (F.col("cumul") >= 10))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r <= 10").select("sample_id", "taxid", F.trim("name").alias("name"), "cumul")


# Alignments and verdicts ------------------------------------------------------------------------------------------

_BEST = "SELECT * FROM aln WHERE mapq >= 10 QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY tstart, tend, identity, mapq, tname) = 1"
_STATS = f"""{A.ALN}, tot AS (SELECT sample_id, taxid, count(*) AS total_reads FROM aln GROUP BY ALL), best AS ({_BEST}),
hs AS (SELECT sample_id, taxid, count(*) AS hits, avg(identity) AS avg_identity FROM best GROUP BY ALL),
ok AS (SELECT * FROM aln WHERE mapq >= 10 AND tend > tstart AND tend <= tlen),
mk AS (SELECT *, CASE WHEN tstart > coalesce(max(tend) OVER (PARTITION BY sample_id, taxid ORDER BY tstart, tend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS new FROM ok),
isl AS (SELECT *, sum(new) OVER (PARTITION BY sample_id, taxid ORDER BY tstart, tend ROWS UNBOUNDED PRECEDING) AS island FROM mk),
iv AS (SELECT sample_id, taxid, min(tstart) AS lo, max(tend) AS hi FROM isl GROUP BY sample_id, taxid, island),
cv AS (SELECT sample_id, taxid, sum(hi - lo)::BIGINT AS covered FROM iv GROUP BY ALL), al AS (SELECT sample_id, taxid, sum(tend - tstart)::BIGINT AS aligned FROM ok GROUP BY ALL),
st AS (SELECT tot.*, coalesce(hits, 0) AS hits, coalesce(hits, 0) / total_reads::DOUBLE AS hit_rate, coalesce(avg_identity, 0.0::DOUBLE) AS avg_identity, coalesce(covered, 0) AS covered,
  coalesce(covered, 0) / 100000::DOUBLE AS breadth, coalesce(aligned / covered::DOUBLE, 0.0::DOUBLE) AS depth FROM tot LEFT JOIN hs USING (sample_id, taxid) LEFT JOIN cv USING (sample_id, taxid) LEFT JOIN al USING (sample_id, taxid))"""
_STATUS = """CASE WHEN hit_rate >= 0.5 AND avg_identity >= 90 AND hits >= 10 {b} THEN 'confirmed' WHEN hit_rate >= 0.25 OR avg_identity >= 81 THEN 'uncertain' ELSE 'rejected' END"""
_NARROW = "AND (breadth >= 0.05 OR (breadth <= 0.05 AND depth >= 10 AND covered >= 200))"
_KEYS = ["sample_id", "taxid"]


def _totals(spark, d):
    return A.alignments(spark, d).groupBy(*_KEYS).agg(F.count("*").alias("total_reads"))


@query(f"WITH {A.ALN} SELECT sample_id, taxid, qname, tstart, tend, identity FROM ({_BEST})")
def blast_first_hsp_dedupe(spark, d):
    return windows.first_per_key(A.alignments(spark, d).filter("mapq >= 10"), [*_KEYS, "qname"], A.ALN_ORDER).select(*_KEYS, "qname", "tstart", "tend", "identity")


@query(f"WITH {_STATS} SELECT * FROM st")
def minimap2_stats(spark, d):
    return validation.alignment_stats(A.alignments(spark, d), _totals(spark, d), _KEYS, A.ALN_ORDER)


@query(f"WITH {_STATS} SELECT sample_id, taxid, lo, hi FROM iv")
def interval_breadth(spark, d):
    return windows.interval_islands(A.alignments(spark, d).filter("mapq >= 10 and tend > tstart and tend <= tlen"), _KEYS)


@query(f"WITH {_STATS} SELECT *, {_STATUS.format(b=_NARROW)} AS status FROM st")
def validation_verdict(spark, d):
    return validation.alignment_verdicts(A.alignments(spark, d), _totals(spark, d), _KEYS, A.ALN_ORDER)


#: Pairs without a hit of high identity have no row of the first method, those without one of good mapping none of the second.
_BLAST = f"""{_STATS}, bb AS (SELECT * FROM aln WHERE identity >= 97 QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY tstart, tend, identity, mapq, tname) = 1),
bs AS (SELECT sample_id, taxid, any_value(total_reads) AS total_reads, count(*) AS hits, count(*) / any_value(total_reads)::DOUBLE AS hit_rate, avg(identity) AS avg_identity FROM bb JOIN tot USING (sample_id, taxid) GROUP BY ALL),
bl AS (SELECT *, {_STATUS.format(b='')} AS status FROM bs), mm AS (SELECT *, {_STATUS.format(b=_NARROW)} AS status FROM st WHERE hits > 0)"""


def _both(spark, d):
    paf, total = A.alignments(spark, d), _totals(spark, d)
    first = validation.blast_verdicts(paf.filter("identity >= 97"), total, _KEYS, A.ALN_ORDER).filter("hits > 0")
    return validation.merge_methods(first, validation.alignment_verdicts(paf, total, _KEYS, A.ALN_ORDER).filter("hits > 0"), _KEYS)


_MERGE = "SELECT sample_id, taxid, CASE WHEN bl.status IS NOT NULL THEN 'blast' ELSE 'minimap2' END AS method, coalesce(bl.hits, mm.hits) AS hits, coalesce(bl.hit_rate, mm.hit_rate) AS hit_rate, coalesce(bl.status, mm.status) AS status, CASE WHEN bl.status IS NOT NULL THEN mm.hits END AS minimap2_hits, CASE WHEN bl.status IS NOT NULL THEN mm.status END AS minimap2_status FROM bl FULL JOIN mm USING (sample_id, taxid)"


@query(f"WITH {_BLAST} {_MERGE}")
def blast_minimap2_merge(spark, d):
    return _both(spark, d)


@query(f"WITH {_BLAST}, me AS ({_MERGE}) SELECT count(DISTINCT sample_id) AS samples, count(*) AS pairs, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'uncertain') AS uncertain, count(*) FILTER (status = 'rejected') AS rejected FROM me")
def validation_summary_counts(spark, d):
    return validation.summary(_both(spark, d))


@query(f"""WITH {A.ALN}, b AS (SELECT DISTINCT taxid, batch_id // 12 AS stage FROM aln), c AS (SELECT b.taxid, b.stage, aln.* EXCLUDE (taxid) FROM b JOIN aln ON aln.taxid = b.taxid AND aln.batch_id // 12 <= b.stage),
t AS (SELECT taxid, stage, count(*) AS total_reads FROM c GROUP BY ALL), h AS (SELECT * FROM c WHERE mapq >= 10 QUALIFY row_number() OVER (PARTITION BY taxid, stage, qname ORDER BY tstart, tend, identity, mapq, tname) = 1),
g AS (SELECT taxid, stage, count(*) AS hits, avg(identity) AS avg_identity FROM h GROUP BY ALL),
s AS (SELECT t.*, coalesce(hits, 0) AS hits, coalesce(hits, 0) / total_reads::DOUBLE AS hit_rate, coalesce(avg_identity, 0.0::DOUBLE) AS avg_identity FROM t LEFT JOIN g USING (taxid, stage)) SELECT *, {_STATUS.format(b='')} AS status FROM s""")
def cumulative_verdict_by_batch(spark, d):
    """Each year's verdict over all batches so far."""
    paf = A.alignments(spark, d).withColumn("stage", F.floor(F.col("batch_id") / 12).cast("long"))
    return validation.verdicts_by_stage(paf, F.col("mapq") >= 10, ["taxid"], "stage", A.ALN_ORDER)


@query(f"WITH {A.ALN} SELECT sample_id, taxid, qname, tname, tstart, tend, mapq, identity, (tend - tstart) / tlen::DOUBLE AS target_share, '-1' AS evalue FROM aln")
def canonical_alignments(spark, d):
    return A.alignments(spark, d).select("sample_id", "taxid", "qname", "tname", "tstart", "tend", "mapq", "identity", ((F.col("tend") - F.col("tstart")) / F.col("tlen")).alias("target_share"), F.lit("-1").alias("evalue"))


@query(f"""WITH {A.ALN}, e AS (SELECT taxid, tname, tstart AS pos, 1 AS d FROM aln UNION ALL SELECT taxid, tname, tend, -1 FROM aln), s AS (SELECT taxid, tname, pos, sum(d) AS d FROM e GROUP BY ALL),
r AS (SELECT taxid, tname, pos, sum(d) OVER w AS depth, lead(pos) OVER (PARTITION BY taxid, tname ORDER BY pos) AS nx FROM s WINDOW w AS (PARTITION BY taxid, tname ORDER BY pos ROWS UNBOUNDED PRECEDING)),
k AS (SELECT taxid, tname, min(pos) AS first_pos, max(nx) - 1 AS last_pos, sum(nx - pos)::BIGINT AS positions, sum((nx - pos) * depth)::BIGINT AS bases FROM r WHERE depth >= 2 AND nx IS NOT NULL GROUP BY ALL)
SELECT taxid, tname, first_pos, last_pos, positions, bases / positions::DOUBLE AS mean_depth FROM k QUALIFY row_number() OVER (PARTITION BY taxid ORDER BY positions DESC, tname) = 1""")
def consensus_window(spark, d):
    found = aggregates.depth_window(A.alignments(spark, d), ["taxid", "tname"], 2)
    best = windows.first_per_key(found, ["taxid"], [F.desc("positions"), "tname"])
    return best.select("taxid", "tname", "first_pos", "last_pos", "positions", (F.col("bases") / F.col("positions")).alias("mean_depth"))


@query(f"WITH RECURSIVE {A.KR}, n AS (SELECT taxid, name, 0 AS p, 0 AS r FROM tax WHERE rank = 'S' AND name NOT LIKE '%1%' UNION ALL SELECT taxid, 'report ' || trim(name), 1, row_no FROM kr WHERE rank = 'S') SELECT taxid, name AS species FROM n QUALIFY row_number() OVER (PARTITION BY taxid ORDER BY p, r, name) = 1")
def species_lookup(spark, d):
    """Seeds whose name is empty, here of names with a 1, leave their taxon to the reports."""
    seeds = A.taxonomy(spark, d).filter(F.col("rank") == "S").withColumn("name", F.when(F.col("name").contains("1"), "").otherwise(F.col("name")))
    return validation.species_names(seeds, A.report(spark, d).withColumn("name", F.concat(F.lit("report "), F.trim("name"))))


# Samples, joins, sets ---------------------------------------------------------------------------------------------


@query("SELECT DISTINCT c_mktsegment || c_nationkey AS sample_id FROM customer EXCEPT SELECT c_mktsegment || c_nationkey FROM customer WHERE c_acctbal > 8000")
def failed_samples(spark, d):
    c = A.table(spark, d, "customer").select(F.concat("c_mktsegment", "c_nationkey").alias("sample_id"), "c_acctbal")
    return joins.failed(c, c.filter("c_acctbal > 8000"))


@query("SELECT DISTINCT c_mktsegment || c_nationkey AS sample_id FROM customer WHERE c_acctbal > 2000 INTERSECT SELECT c_mktsegment || c_nationkey FROM customer WHERE c_acctbal < 1000")
def produced_samples(spark, d):
    c = A.table(spark, d, "customer").select(F.concat("c_mktsegment", "c_nationkey").alias("sample_id"), "c_acctbal")
    return joins.produced(c.filter("c_acctbal > 2000"), c.filter("c_acctbal < 1000"))


@query("SELECT coalesce(a.k, b.k) AS key, CASE WHEN a.k IS NULL THEN 'no_reads' WHEN b.k IS NULL THEN 'no_genome' ELSE 'matched' END AS kind FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT c_custkey * 2 AS k FROM customer) b ON a.k = b.k")
def half_rows_full_outer(spark, d):
    a = A.table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    b = A.table(spark, d, "customer").select((F.col("c_custkey") * 2).alias("key"))
    return joins.classify_halves(a, b, ["key"], "no_reads", "no_genome")


@query("SELECT n_nationkey AS item, n_regionkey = 1 OR n_regionkey = 3 AS passed FROM nation")
def branch_split(spark, d):
    n = A.table(spark, d, "nation")
    yes, no = joins.branch(n, F.col("n_regionkey").isin(1, 3))
    return joins.union_all(yes.select(F.col("n_nationkey").alias("item"), F.lit(True).alias("passed")), no.select(F.col("n_nationkey").alias("item"), F.lit(False).alias("passed")))


@query("SELECT n_name AS process, string_agg(DISTINCT c_mktsegment || ': ' || (c_custkey % 5), chr(10) ORDER BY c_mktsegment || ': ' || (c_custkey % 5)) AS versions FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def versions_collation(spark, d):
    rows = A.table(spark, d, "customer").join(A.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return aggregates.collate_versions(rows.select(F.concat(F.lit("MAIN:SUB:"), "n_name").alias("process"), F.col("c_mktsegment").alias("tool"), (F.col("c_custkey") % 5).cast("string").alias("version")))


# Files, batches, sessions -----------------------------------------------------------------------------------------


@query(f"WITH {A.FM} SELECT event_id, batch_id FROM fm")
def count_batches(spark, d):
    return A.files(spark, d).select("event_id", "batch_id")


_SNAP = """sn AS (SELECT batch_id, count(*) AS files, sum(file_size)::BIGINT AS total_bytes, round(sum(file_size) / 1048576.0::DOUBLE, 2) AS total_mb, sum(estimated_reads)::BIGINT AS reads, count(*) FILTER (is_compressed) AS compressed,
  avg(priority_score) AS avg_priority, max(priority_score) AS max_priority, min(priority_score) AS min_priority, count(*) FILTER (priority_score > 100) AS high_priority, max(file_age_ms) AS oldest_ms, min(file_age_ms) AS newest_ms,
  count(*) FILTER (file_size > 52428800) / count(*)::DOUBLE AS large_ratio, count(*) FILTER (is_compressed) / count(*)::DOUBLE AS compressed_ratio FROM fm GROUP BY 1)"""


@query(f"WITH {A.FM}, {_SNAP} SELECT * FROM sn")
def snapshot_stats(spark, d):
    return aggregates.snapshot(A.files(spark, d), ["batch_id"])


@query(f"WITH {A.FM} SELECT batch_id, watch_dir, count(*) AS files FROM fm GROUP BY ALL")
def directory_counts(spark, d):
    return aggregates.directory_counts(A.files(spark, d))


@query(f"WITH {A.FM}, {_SNAP} SELECT batch_id, count(*) OVER w AS batches, (sum(files) OVER w)::BIGINT AS total_files, (sum(reads) OVER w)::BIGINT AS total_reads, (sum(files) OVER w) / (count(*) OVER w)::DOUBLE AS files_per_batch, (sum(reads) OVER w) / (count(*) OVER w)::DOUBLE AS reads_per_batch FROM sn WINDOW w AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING)")
def cumulative_session_stats(spark, d):
    return aggregates.session(aggregates.snapshot(A.files(spark, d), ["batch_id"])).drop("total_mb")


@query(f"WITH {A.FM}, f AS (SELECT sample_id, min(batch_id) AS batch_id FROM fm GROUP BY 1), n AS (SELECT b.batch_id, count(f.sample_id) AS new FROM (SELECT DISTINCT batch_id FROM fm) b LEFT JOIN f USING (batch_id) GROUP BY 1) SELECT batch_id, new, (sum(new) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING))::BIGINT AS known FROM n")
def cumulative_distinct_sources(spark, d):
    return aggregates.distinct_so_far(A.files(spark, d), "sample_id")


@query(f"WITH {A.FM}, {_SNAP}, t AS (SELECT batch_id, list(files * 1000 + oldest_ms // 1000) OVER (ORDER BY batch_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS l FROM sn) SELECT batch_id, array_to_string(l, ',') AS trend FROM t")
def trend_last_100(spark, d):
    s = aggregates.snapshot(A.files(spark, d), ["batch_id"]).withColumn("v", F.col("files") * 1000 + F.floor(F.col("oldest_ms") / 1000))
    out = windows.last_n(s, [], "batch_id", "v", 100)
    return out.select("batch_id", F.array_join(F.transform("trend", lambda x: x.cast("string")), ",").alias("trend"))


@query(f"WITH {A.FM}, {_SNAP} SELECT batch_id, 'throughput' AS type, 'warning' AS level, 'files' AS metric, files::DOUBLE AS value, 10.0::DOUBLE AS threshold FROM sn WHERE files < 10 UNION ALL SELECT batch_id, 'file_age', 'warning', 'oldest_ms', oldest_ms::DOUBLE, 970000.0 FROM sn WHERE oldest_ms > 970000 UNION ALL SELECT batch_id, 'compression', 'info', 'compressed_ratio', compressed_ratio, 0.3 FROM sn WHERE compressed_ratio < 0.3")
def alerts(spark, d):
    return aggregates.alerts(aggregates.snapshot(A.files(spark, d), ["batch_id"]), 10, 970_000, 0.3)


@query(f"WITH {A.FM} SELECT event_id, watch_dir, row_number() OVER (PARTITION BY batch_id, watch_dir ORDER BY event_id) AS turn, min(event_id) OVER (PARTITION BY batch_id, watch_dir) AS group_order FROM fm")
def round_robin_interleave(spark, d):
    f = A.files(spark, d).withColumn("g", F.struct("batch_id", "watch_dir"))
    return windows.round_robin(f, "g", "event_id").select("event_id", "watch_dir", "turn", "group_order")


@query(f"WITH {A.FM}, s AS (SELECT *, row_number() OVER (PARTITION BY watch_dir ORDER BY batch_id, event_id) - 1 AS serve FROM fm) SELECT event_id, batch_id, watch_dir, serve, row_number() OVER (PARTITION BY batch_id ORDER BY serve, watch_dir) AS place FROM s")
def fair_interleave_cross_batch(spark, d):
    return windows.fair_turns(A.files(spark, d), "batch_id", "watch_dir", "event_id").select("event_id", "batch_id", "watch_dir", "serve", "place")


@query(f"WITH {A.FM} SELECT watch_dir, count(*) FILTER (arrival < 333) AS included, count(*) FILTER (arrival >= 333) AS excluded FROM fm GROUP BY 1")
def max_files_truncation(spark, d):
    return windows.truncation(A.files(spark, d), "watch_dir", "event_id", 333)


@query(f"WITH {A.FM} SELECT event_id, CASE WHEN contains(sample_id, '7') OR regexp_full_match(sample_id, '1[0-4]') THEN 'priority' ELSE 'normal' END AS route FROM fm")
def priority_routing(spark, d):
    patterns = F.array(F.lit("7"), F.lit("1[0-4]"))
    hit = F.exists(patterns, lambda p: F.contains(F.col("sample_id"), p) | F.regexp_like(F.col("sample_id"), F.concat(F.lit("^(?:"), p, F.lit(")$"))))
    return A.files(spark, d).select("event_id", F.when(hit, "priority").otherwise("normal").alias("route"))


@query(f"WITH {A.FM}, e AS (SELECT sample_id, max(arrival) % 5 + 1 AS nx FROM fm GROUP BY 1 HAVING max(file_size) > 220000000) SELECT event_id, fm.sample_id, (row_number() OVER (PARTITION BY fm.sample_id ORDER BY event_id) - 1 + coalesce(nx, 0))::BIGINT AS batch_no FROM fm LEFT JOIN e USING (sample_id)")
def batch_numbering(spark, d):
    f = A.files(spark, d)
    existing = f.groupBy("sample_id").agg((F.max("arrival") % 5).alias("batch_id"), F.max("file_size").alias("largest")).filter("largest > 220000000")
    return windows.batch_numbers(f, "sample_id", ["event_id"], existing, "batch_no").select("event_id", "sample_id", "batch_no")


@query(f"WITH {A.FM} SELECT event_id, sample_id FROM fm QUALIFY (row_number() OVER (PARTITION BY sample_id ORDER BY event_id) - 1) % 10 = 0")
def every_nth_batch(spark, d):
    return windows.every_nth(windows.batch_numbers(A.files(spark, d), "sample_id", ["event_id"], name="n"), "n", 10).select("event_id", "sample_id")


@query(f"""WITH {A.FM}, k AS (SELECT event_id, sample_id, priority_score, lag(priority_score) OVER (PARTITION BY sample_id ORDER BY event_id) AS was, watch_dir = 'purchase' AS b FROM fm),
r AS (SELECT event_id, b, sum(CASE WHEN was IS NULL THEN 1 ELSE 0 END) OVER w AS keys, sum(priority_score - coalesce(was, 0)) OVER w AS latest_sum, sum(b::INT) OVER w AS nb FROM k WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, keys::BIGINT AS keys, latest_sum::BIGINT AS latest_sum FROM r WHERE b AND nb % 3 = 0""")
def snapshot_accumulator(spark, d):
    return windows.latest_as_of(A.files(spark, d), "sample_id", "priority_score", "event_id", F.col("watch_dir") == "purchase", 3)


@query(f"WITH {A.FM} SELECT event_id, estimated_reads, round(file_size / 1048576.0::DOUBLE, 2) AS mb, greatest(1, least(50, (file_size % 97)::BIGINT)) AS batch_size FROM fm")
def estimated_reads(spark, d):
    return A.files(spark, d).select("event_id", "estimated_reads", scalars.megabytes(F.col("file_size")).alias("mb"), scalars.clamp(F.col("file_size") % 97, 1, 50).alias("batch_size"))


# Scalars ----------------------------------------------------------------------------------------------------------

_BC = "regexp_extract(path, '(?i)barcode(\\d+)', 1)"
_BARCODE = f"CASE WHEN {_BC} <> '' THEN 'barcode' || CASE WHEN length({_BC}) < 2 THEN lpad({_BC}, 2, '0') ELSE {_BC} END END"


@query(f"WITH {A.PATHS}, b AS (SELECT file_id, {_BARCODE} AS barcode FROM paths) SELECT file_id, barcode, coalesce(regexp_matches(barcode, '^barcode[0-9]{{2}}$'), false) AS valid, TRY_CAST(regexp_extract(barcode, 'barcode(\\d+)', 1) AS INTEGER) AS number, CASE WHEN file_id % 150 BETWEEN 1 AND 99 THEN 'barcode' || lpad((file_id % 150)::VARCHAR, 2, '0') END AS made FROM b")
def barcode_scalars(spark, d):
    b = A.paths(spark, d).withColumn("barcode", scalars.extract_barcode(F.col("path")))
    c = F.col("barcode")
    return b.select("file_id", "barcode", scalars.is_valid_barcode(c).alias("valid"), scalars.barcode_number(c).alias("number"), scalars.format_barcode(F.col("file_id") % 150).alias("made"))


_STEM = "regexp_replace(split_part(path, '/', -1), '\\.(fastq|fq)(\\.gz)?$', '')"
_PARENT = "split_part(path, '/', -2)"


@query(f"WITH {A.PATHS}, x AS (SELECT file_id, path, {_STEM} AS stem, {_PARENT} AS parent FROM paths), b AS (SELECT file_id, stem AS path, parent, path AS p FROM x) SELECT file_id, CASE WHEN regexp_matches(parent, '^barcode\\d+$') THEN parent ELSE coalesce(nullif(regexp_extract(split_part(p, '/', -1), '^sample-(\\d+)', 1), ''), CASE WHEN parent IN ('fastq_pass', 'output') THEN {_BARCODE} END, path) END AS sample_id FROM b")
def sample_id_chain(spark, d):
    return A.paths(spark, d).select("file_id", scalars.sample_id(F.col("path"), r"^sample-(\d+)").alias("sample_id"))


@query(f"WITH {A.PATHS} SELECT file_id, {_STEM} AS stem, {_PARENT} AS parent, split_part(path, '/', -1) AS name, starts_with(split_part(path, '/', -1), '.') AS hidden FROM paths")
def stem_strip(spark, d):
    p = F.col("path")
    return A.paths(spark, d).select("file_id", scalars.fastq_stem(p).alias("stem"), scalars.parent_dir(p).alias("parent"), scalars.basename(p).alias("name"), scalars.basename(p).startswith(".").alias("hidden"))


_DUR = "CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 900) || 'ms' WHEN 1 THEN (o_orderkey % 90) || '.5s' WHEN 2 THEN (o_orderkey % 50) || 'm' ELSE (o_orderkey % 5) || 'h' END"


def _trace(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.concat(k % 900, F.lit("ms"))).when(k % 4 == 1, F.concat(k % 90, F.lit(".5s"))).when(k % 4 == 2, F.concat(k % 50, F.lit("m"))).otherwise(F.concat(k % 5, F.lit("h")))
    memory = F.concat(k % 64, F.when(k % 3 == 0, " GB").when(k % 3 == 1, " MB").otherwise(" KB"))
    return A.table(spark, d, "orders").select(F.col("o_orderkey").alias("task"), F.concat(F.lit("MAIN:"), "o_orderpriority").alias("process"), text.alias("duration"), memory.alias("memory"), (k % 100).cast("double").alias("cpu"))


_TR = f"tr AS (SELECT o_orderkey AS task, o_orderpriority AS name, CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 900)::DOUBLE WHEN 1 THEN ((o_orderkey % 90) + 0.5)::DOUBLE * 1000 WHEN 2 THEN (o_orderkey % 50)::DOUBLE * 60000 ELSE (o_orderkey % 5)::DOUBLE * 3600000 END AS duration_ms, CASE o_orderkey % 3 WHEN 0 THEN (o_orderkey % 64)::DOUBLE * 1024 WHEN 1 THEN (o_orderkey % 64)::DOUBLE ELSE (o_orderkey % 64)::DOUBLE / 1024 END AS memory_mb, (o_orderkey % 100)::DOUBLE AS cpu FROM orders)"


@query(f"WITH {_TR} SELECT task, duration_ms, memory_mb FROM tr")
def parse_durations(spark, d):
    return _trace(spark, d).select("task", scalars.duration_ms(F.col("duration")).alias("duration_ms"), scalars.memory_mb(F.col("memory")).alias("memory_mb"))


@query(f"WITH {_TR} SELECT name, count(*) AS tasks, avg(duration_ms) AS avg_duration_ms, max(memory_mb) AS max_memory_mb, avg(cpu) AS avg_cpu FROM tr GROUP BY 1")
def trace_aggregation(spark, d):
    t = _trace(spark, d).select(scalars.process_tail(F.col("process")).alias("name"), scalars.duration_ms(F.col("duration")).alias("duration_ms"), scalars.memory_mb(F.col("memory")).alias("memory_mb"), "cpu")
    return aggregates.trace_stats(t)


_TXT = "CASE o_orderkey % 5 WHEN 0 THEN '1,234' WHEN 1 THEN o_orderkey::VARCHAR WHEN 2 THEN '5.0' WHEN 3 THEN (o_orderkey % 100) || '%' ELSE 'n/a' END"


@query(f"WITH t AS (SELECT o_orderkey AS id, {_TXT} AS s FROM orders) SELECT id, coalesce(CASE WHEN regexp_full_match(trim(replace(s, '%', '')), '[+-]?[0-9]+') THEN TRY_CAST(trim(replace(s, '%', '')) AS BIGINT) END, 0) AS i, coalesce(TRY_CAST(trim(replace(s, '%', '')) AS DOUBLE), 0.0::DOUBLE) AS f, TRY_CAST(replace(s, ',', '') AS DOUBLE) AS plain, TRY_CAST(regexp_replace(s, '\\D', '', 'g') AS BIGINT) AS digits FROM t")
def safe_casts(spark, d):
    k = F.col("o_orderkey")
    s = F.when(k % 5 == 0, "1,234").when(k % 5 == 1, k.cast("string")).when(k % 5 == 2, "5.0").when(k % 5 == 3, F.concat(k % 100, F.lit("%"))).otherwise("n/a")
    t = A.table(spark, d, "orders").select(k.alias("id"), s.alias("s"))
    s = F.col("s")
    return t.select("id", scalars.safe_int(s).alias("i"), scalars.safe_double(s).alias("f"), scalars.without_commas(s).try_cast("double").alias("plain"), scalars.digits_only(s).alias("digits"))


@query("SELECT c_custkey AS id, 'krak|' || c_mktsegment || '|' || CASE WHEN c_custkey % 3 = 0 THEN 'final' ELSE (c_custkey % 3)::VARCHAR END AS k, 'v1.' || c_nationkey || CASE WHEN c_custkey % 2 = 0 THEN '-gabcdef0' ELSE '' END AS version FROM customer")
def keys_and_versions(spark, d):
    k = F.col("c_custkey")
    batch, commit = F.when(k % 3 != 0, k % 3), F.when(k % 2 == 0, F.lit("abcdef0123"))
    return A.table(spark, d, "customer").select(k.alias("id"), scalars.snapshot_key(F.col("c_mktsegment"), batch).alias("k"), scalars.version_string(F.concat(F.lit("1."), "c_nationkey"), commit).alias("version"))


# Reads and assemblies ---------------------------------------------------------------------------------------------

_HALF = "SELECT sample_id, {n} FROM (SELECT *, sum(length) OVER w AS cum, sum(length) OVER (PARTITION BY sample_id) AS al, row_number() OVER w AS rn FROM {t} WINDOW w AS (PARTITION BY sample_id ORDER BY length DESC, {id} ROWS UNBOUNDED PRECEDING)) WHERE cum * 2 >= al GROUP BY 1"


@query("WITH d AS (SELECT source AS sample_id, doc_id, n_chars AS length FROM documents) " + _HALF.format(t="d", id="doc_id", n="max(length) AS n50, min(rn) AS l50"))
def read_length_n50(spark, d):
    return windows.half_mass(A.table(spark, d, "documents").select(F.col("source").alias("sample_id"), F.col("n_chars").alias("length")), ["sample_id"])


@query(f"WITH {A.READS} SELECT sample_id, count(*) AS num_seqs, sum(length(sequence))::BIGINT AS sum_len, min(length(sequence))::INTEGER AS min_len, avg(length(sequence)) AS avg_len, max(length(sequence))::INTEGER AS max_len, quantile_cont(length(sequence), 0.25)::DOUBLE AS q1, quantile_cont(length(sequence), 0.5)::DOUBLE AS q2, quantile_cont(length(sequence), 0.75)::DOUBLE AS q3 FROM reads GROUP BY 1")
def read_set_stats(spark, d):
    return aggregates.read_set_stats(A.reads(spark, d), ["sample_id"])


@query(f"WITH {A.READS}, q AS (SELECT *, list_sum(list_transform(string_split(quality, ''), lambda c: ascii(c) - 33)) / length(quality)::DOUBLE AS mq FROM reads WHERE length(sequence) BETWEEN 1000 AND 9000) SELECT sample_id, read_id, substring(sequence, 11, length(sequence) - 15) AS sequence FROM q WHERE mq >= 66")
def read_filter_lengths(spark, d):
    f = reads.ReadFilter(66.0, 1000, 9000, 10, 5)
    return reads.filter_reads(A.reads(spark, d), f, reads.arithmetic_quality(F.col("quality"))).select("sample_id", "read_id", "sequence")


@query(f"WITH {A.READS}, r AS (SELECT sample_id, read_id, length(sequence) AS n FROM reads WHERE length(sequence) >= 1000), c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY sample_id ORDER BY n DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY sample_id) AS al FROM r) SELECT sample_id, read_id FROM c WHERE before * 100 < al * 90")
def keep_best_percent(spark, d):
    return reads.keep_best_reads(A.reads(spark, d), ["sample_id"], 90, columns=["sample_id", "read_id"])


@query(f"WITH {A.READS} SELECT sample_id, sum(length(regexp_replace(sequence, '[^GCgc]', '', 'g')))::BIGINT AS gc, sum(length(regexp_replace(sequence, '[^ACGTacgt]', '', 'g')))::BIGINT AS acgt, sum(length(regexp_replace(sequence, '[^GCgc]', '', 'g'))) / sum(length(regexp_replace(sequence, '[^ACGTacgt]', '', 'g')))::DOUBLE AS gc_fraction FROM reads GROUP BY 1")
def gc_fraction(spark, d):
    return reads.gc_fraction(A.reads(spark, d), ["sample_id"])


_W = "sum({c} * sum_len) / sum(sum_len)"


@query(f"WITH {A.READS}, {A.SKS}, m AS (SELECT sample_id, sum(num_seqs)::BIGINT AS num_seqs, sum(sum_len)::BIGINT AS sum_len, min(min_len) AS min_len, max(max_len) AS max_len, {_W.format(c='q20')} AS q20, {_W.format(c='q30')} AS q30, {_W.format(c='avg_qual')} AS avg_qual, {_W.format(c='gc')} AS gc FROM sks GROUP BY 1) SELECT *, sum_len / num_seqs::DOUBLE AS avg_len, sum_len / num_seqs::DOUBLE * 0.75 AS q1, sum_len / num_seqs::DOUBLE AS q2, sum_len / num_seqs::DOUBLE * 1.5 AS q3, floor(sum_len / num_seqs::DOUBLE)::BIGINT AS n50, (num_seqs // 2)::BIGINT AS n50_num FROM m")
def seqkit_weighted_merge(spark, d):
    return aggregates.merge_read_stats(A.read_stats(spark, d), ["sample_id"])


@query(f"WITH {A.READS}, {A.SKS} SELECT sample_id, batch, num_seqs, sum_len FROM sks QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY batch DESC) = 1")
def latest_stats_per_sample(spark, d):
    return aggregates.latest(A.read_stats(spark, d).select("sample_id", "batch", "num_seqs", "sum_len"), ["sample_id"], ["batch"])


@query(f"WITH {A.CTG}, h AS (" + _HALF.format(t="ctg", id="name", n="max(length) AS n50, min(rn) AS l50") + ") SELECT sample_id, count(*) AS total_contigs, sum(length)::BIGINT AS total_length, max(length) AS longest, count(*) FILTER (circular) AS circular_contigs, any_value(n50) AS n50, any_value(l50) AS l50 FROM ctg JOIN h USING (sample_id) GROUP BY 1")
def assembly_summary(spark, d):
    return reads.assembly_summary(A.contigs(spark, d), ["sample_id"])


@query(f"WITH {A.READS}, x AS (SELECT sample_id, read_id, length(sequence) AS n, length(regexp_replace(sequence, '[^Nn]', '', 'g')) AS ns, len(list_filter(string_split(quality, ''), lambda c: c <> '' AND ascii(c) - 33 < 15)) AS low FROM reads) SELECT sample_id, CASE WHEN n < 15 THEN 'too_short' WHEN low * 100.0 > n * 40.0 THEN 'low_quality' WHEN ns > 5 THEN 'too_many_N' ELSE 'passed' END AS verdict, count(*) AS reads FROM x GROUP BY ALL")
def fastp_filter_counts(spark, d):
    r = A.reads(spark, d)
    return r.select("sample_id", reads.fastp_verdict(F.col("sequence"), F.col("quality")).alias("verdict")).groupBy("sample_id", "verdict").agg(F.count("*").alias("reads"))


# Comparisons ------------------------------------------------------------------------------------------------------

_CMP = "cmp AS (SELECT l_returnflag AS tool, count(*) FILTER (l_quantity > 15) / count(*)::DOUBLE AS retention, avg(CASE WHEN l_quantity > 15 THEN l_linenumber * 3 END) - avg(l_linenumber * 3) AS quality_delta, avg(CASE WHEN l_quantity > 15 THEN l_linenumber * 3 END) AS quality_after FROM lineitem GROUP BY 1)"


def _compared(spark, d):
    keep, q = F.col("l_quantity") > 15, F.col("l_linenumber") * 3
    s = A.table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("tool")).agg(F.count("*").alias("reads_before"), F.count_if(keep).alias("reads_after"), F.avg(q).alias("quality_before"), F.avg(F.when(keep, q)).alias("quality_after"))
    return aggregates.compare_tools(s)


@query(f"WITH {_CMP} SELECT tool, retention, quality_delta, quality_delta / (1.0::DOUBLE - retention + 0.001::DOUBLE) AS efficiency, quality_after FROM cmp")
def qc_tool_comparison(spark, d):
    return _compared(spark, d)


@query(f"WITH {_CMP} SELECT tool, 'relax filters: many reads are lost' AS advice FROM cmp WHERE retention < 0.7 UNION ALL SELECT tool, 'little gain in quality' FROM cmp WHERE quality_delta < 0.05 UNION ALL SELECT tool, 'high quality after filtering' FROM cmp WHERE quality_after > 12")
def qc_recommendations(spark, d):
    return aggregates.recommendations(_compared(spark, d))


_YEAR = "SELECT o_orderpriority || o_orderstatus AS name, count(*)::DOUBLE AS value FROM orders WHERE year(o_orderdate) {c} GROUP BY 1"


@query(f"WITH b AS ({_YEAR.format(c='<= 1997')}), c AS ({_YEAR.format(c='> 1997')}) SELECT name, (c.value - b.value) / b.value AS delta, CASE WHEN (c.value - b.value) / b.value > 0.1 THEN 'regression' WHEN (c.value - b.value) / b.value < -0.1 THEN 'improvement' ELSE 'stable' END AS verdict FROM b JOIN c USING (name) WHERE b.value <> 0")
def benchmark_regressions(spark, d):
    o = A.table(spark, d, "orders").withColumn("name", F.concat("o_orderpriority", "o_orderstatus"))
    per = lambda x: x.groupBy("name").agg(F.count("*").cast("double").alias("value"))
    return aggregates.regressions(per(o.filter(F.year("o_orderdate") <= 1997)), per(o.filter(F.year("o_orderdate") > 1997)))


@query("SELECT coalesce(p_brand, 'all') AS component, coalesce(CASE WHEN p_size < 17 THEN 'P0' WHEN p_size < 34 THEN 'P1' ELSE 'P2' END, 'all') AS priority, count(*) AS tests, count(*) FILTER (p_partkey % 3 = 0) AS covered FROM part GROUP BY ROLLUP (p_brand, CASE WHEN p_size < 17 THEN 'P0' WHEN p_size < 34 THEN 'P1' ELSE 'P2' END)")
def coverage_rollup(spark, d):
    p = A.table(spark, d, "part").select(F.col("p_brand").alias("component"), F.when(F.col("p_size") < 17, "P0").when(F.col("p_size") < 34, "P1").otherwise("P2").alias("priority"), (F.col("p_partkey") % 3 == 0).alias("hit"))
    return p.rollup("component", "priority").agg(F.count("*").alias("tests"), F.count_if("hit").alias("covered")).na.fill("all", ["component", "priority"])


# Classification by k-mers, trimming, outputs ------------------------------------------------------------------------

_LETTERS = ("0123456789abcdef", "ACGTACGTACGTACGT")
_K = 8


def _letters(text: Column) -> Column:
    return F.translate(F.md5(text.cast("string").cast("binary")), *_LETTERS)


def _dna(x: str) -> str:
    return "translate(md5({}), '{}', '{}')".format(x, *_LETTERS)


@query(f"""WITH RECURSIVE {A.UP}, g AS (SELECT (1000 + s_suppkey)::VARCHAR AS taxid, {_dna('s_suppkey::VARCHAR')} AS s FROM supplier), gk AS (SELECT DISTINCT taxid, substring(s, i::INT, {_K}) AS kmer FROM g, range(1, 26) r(i)),
dp AS (SELECT taxid AS ancestor, count(*) AS depth FROM up GROUP BY 1), nn AS (SELECT kmer, count(*) AS n FROM gk GROUP BY 1), sh AS (SELECT kmer, ancestor, count(*) AS m FROM gk JOIN up USING (taxid) GROUP BY ALL),
kt AS (SELECT kmer, arg_max(ancestor, depth) AS taxid FROM sh JOIN nn USING (kmer) JOIN dp USING (ancestor) WHERE m = n GROUP BY 1),
rd AS (SELECT o_orderkey::VARCHAR AS read_id, CASE WHEN o_orderkey % 5 = 0 THEN substring({_dna("'x' || o_orderkey")}, 1, 26) ELSE substring({_dna('(o_orderkey % 10 + 1)::VARCHAR')}, (o_orderkey % 7 + 1)::INT, 20) || substring({_dna('o_orderkey::VARCHAR')}, 1, 6) END AS s FROM orders),
rk AS (SELECT read_id, substring(s, i::INT, {_K}) AS kmer FROM rd, range(1, 20) r(i)), vt AS (SELECT read_id, taxid, count(*) AS n FROM rk JOIN kt USING (kmer) GROUP BY ALL),
sc AS (SELECT v.read_id, v.taxid, sum(w.n) AS score FROM vt v JOIN up ON up.taxid = v.taxid JOIN vt w ON w.read_id = v.read_id AND w.taxid = up.ancestor GROUP BY ALL),
bs AS (SELECT read_id, sc.taxid, score >= 19 * 0.3 AS ok FROM sc JOIN dp ON dp.ancestor = sc.taxid QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, depth DESC, sc.taxid) = 1)
SELECT read_id, CASE WHEN ok THEN 'C' ELSE 'U' END AS status, CASE WHEN ok THEN taxid ELSE '0' END AS taxid FROM rd LEFT JOIN bs USING (read_id)""")
def kmer_classification(spark, d):
    own_reads, genomes, tax = _short_reads(spark, d)
    return kmer.classify(own_reads, kmer.build_table(genomes, tax, _K), tax, _K, confidence=0.3)


def _short_reads(spark, d):
    """Reads of 26 letters, genomes of 32 and their taxonomy."""
    k = F.col("o_orderkey")
    own = F.concat(F.substring(_letters(k % 10 + 1), (k % 7 + 1).cast("int"), F.lit(20)), F.substring(_letters(k), 1, 6))
    noise = F.substring(_letters(F.concat(F.lit("x"), k)), 1, 26)
    own_reads = A.table(spark, d, "orders").select(k.cast("string").alias("read_id"), F.when(k % 5 == 0, noise).otherwise(own).alias("sequence"))
    genomes = A.table(spark, d, "supplier").select((F.col("s_suppkey") + 1000).cast("string").alias("taxid"), _letters(F.col("s_suppkey")).alias("sequence"))
    return own_reads, genomes, A.taxonomy(spark, d)


_M = kmer.Minimizers(k=11, l=8, spaces=2)


def _minimizer_sql(source: str, ids: str, size: int) -> str:
    """(ids, pos, m): the minimizer of each k-mer of strings `s` of `size` letters, letter by letter."""
    code = lambda x, back: " + ".join(f"(strpos('{'TGCA' if back else 'ACGT'}', substring({x}, {i + 1}, 1)) - 1)::BIGINT * {4 ** (i if back else _M.l - 1 - i)}" for i in range(_M.l))
    least = f"xor(least({code('w', False)}, {code('w', True)}) & {_M.mask}::BIGINT, {_M.toggle & _M.mask}::BIGINT)"
    words = f"(SELECT {ids}, i, substring(s, i::INT, {_M.l}) AS w FROM {source}, range(1, {size - _M.l + 2}) r(i))"
    return f"SELECT {ids}, pos, min(c) AS m FROM (SELECT {ids}, i, {least} AS c FROM {words}), range(1, {size - _M.k + 2}) q(pos) WHERE i BETWEEN pos AND pos + {_M.k - _M.l} GROUP BY ALL"


@query(f"""WITH RECURSIVE {A.UP}, g AS (SELECT (1000 + s_suppkey)::VARCHAR AS taxid, {_dna('s_suppkey::VARCHAR')} AS s FROM supplier), gk AS (SELECT DISTINCT taxid, m FROM ({_minimizer_sql('g', 'taxid', 32)})),
dp AS (SELECT taxid AS ancestor, count(*) AS depth FROM up GROUP BY 1), nn AS (SELECT m, count(*) AS n FROM gk GROUP BY 1), sh AS (SELECT m, ancestor, count(*) AS c FROM gk JOIN up USING (taxid) GROUP BY ALL),
kt AS (SELECT m, arg_max(ancestor, depth) AS taxid FROM sh JOIN nn USING (m) JOIN dp USING (ancestor) WHERE c = n GROUP BY 1),
rd AS (SELECT o_orderkey::VARCHAR AS read_id, CASE WHEN o_orderkey % 5 = 0 THEN substring({_dna("'x' || o_orderkey")}, 1, 26) ELSE substring({_dna('(o_orderkey % 10 + 1)::VARCHAR')}, (o_orderkey % 7 + 1)::INT, 20) || substring({_dna('o_orderkey::VARCHAR')}, 1, 6) END AS s FROM orders),
rk AS ({_minimizer_sql('rd', 'read_id', 26)}), rl AS (SELECT *, CASE WHEN m = lag(m) OVER (PARTITION BY read_id ORDER BY pos) THEN 0 ELSE 1 END AS first FROM rk),
vt AS (SELECT read_id, taxid, count(*) AS n, sum(first) AS runs FROM rl JOIN kt USING (m) GROUP BY ALL), gr AS (SELECT read_id, sum(runs) AS hits FROM vt GROUP BY 1),
sc AS (SELECT v.read_id, v.taxid, sum(w.n) AS score FROM vt v JOIN up ON up.taxid = v.taxid JOIN vt w ON w.read_id = v.read_id AND w.taxid = up.ancestor GROUP BY ALL),
bs AS (SELECT read_id, sc.taxid, score >= 16 * 0.3 AND hits >= 2 AS ok FROM sc JOIN gr USING (read_id) JOIN dp ON dp.ancestor = sc.taxid QUALIFY row_number() OVER (PARTITION BY read_id ORDER BY score DESC, depth DESC, sc.taxid) = 1)
SELECT read_id, CASE WHEN ok THEN 'C' ELSE 'U' END AS status, CASE WHEN ok THEN taxid ELSE '0' END AS taxid FROM rd LEFT JOIN bs USING (read_id)""")
def minimizer_classification(spark, d):
    own_reads, genomes, tax = _short_reads(spark, d)
    return kmer.classify_minimizers(own_reads, kmer.build_minimizer_table(genomes, tax, _M), tax, _M, confidence=0.3, min_hit_groups=2)


_ADAPTER = "AATGTACTTCG"
_CUTS = sorted({_ADAPTER[i:] for i in range(4)}, key=len, reverse=True), sorted({_ADAPTER[: 11 - i] for i in range(4)}, key=len, reverse=True)


@query(f"WITH r AS (SELECT p_partkey AS read_id, substring('{_ADAPTER}', (p_partkey % 11 + 1)::INT) || 'CCGGTTAACC' || substring('{_ADAPTER}', 1, (p_partkey % 12)::INT) AS s FROM part) SELECT read_id, regexp_replace(regexp_replace(s, '^(?:{'|'.join(_CUTS[0])})', ''), '(?:{'|'.join(_CUTS[1])})$', '') AS sequence FROM r")
def adapter_trimming(spark, d):
    k = F.col("p_partkey")
    a = F.lit(_ADAPTER)
    s = F.concat(F.substring(a, (k % 11 + 1).cast("int"), F.lit(11)), F.lit("CCGGTTAACC"), F.substring(a, F.lit(1), (k % 12).cast("int")))
    r = A.table(spark, d, "part").select(k.alias("read_id"), s.alias("sequence"), s.alias("quality"))
    return reads.trim_adapters(r, [_ADAPTER]).select("read_id", "sequence")


@query("WITH c AS (SELECT p_partkey AS contig, repeat('N', (p_partkey % 4)::INT) || 'AC' || repeat('N', (p_partkey % 3)::INT) || 'GT' || repeat('N', (p_partkey % 5)::INT) AS s FROM part), t AS (SELECT contig, regexp_replace(s, '^N+|N+$', '', 'g') AS s FROM c) SELECT contig, s AS sequence, length(s) - length(replace(s, 'N', '')) AS masked FROM t")
def masked_consensus(spark, d):
    k = F.col("p_partkey")
    n = lambda m: F.repeat(F.lit("N"), (k % m).cast("int"))
    t = A.table(spark, d, "part").select(k.alias("contig"), windows.trim_masked(F.concat(n(4), F.lit("AC"), n(3), F.lit("GT"), n(5))).alias("sequence"))
    return t.select("contig", "sequence", reads.base_count(F.col("sequence"), "N").cast("long").alias("masked"))


_MQ = "list_sum(list_transform(string_split(quality, ''), lambda c: ascii(c) - 33)) / length(quality)::DOUBLE"


@query(f"WITH {A.READS}, q AS (SELECT sample_id, read_id, length(sequence) AS length, {_MQ} AS mq FROM reads), h AS ({_HALF.format(t='q', id='read_id', n='max(length) AS n50')}) SELECT q.sample_id, count(*) AS reads, sum(length)::BIGINT AS bases, quantile_cont(length, 0.5)::DOUBLE AS median_length, count(*) FILTER (mq > 66) AS above_q66, any_value(n50) AS n50 FROM q JOIN h USING (sample_id) GROUP BY 1")
def read_summary(spark, d):
    r = A.reads(spark, d).withColumn("mean_q", reads.arithmetic_quality(F.col("quality")))
    return reads.read_summary(r, ["sample_id"], marks=(66,)).select("sample_id", "reads", "bases", "median_length", "above_q66", "n50")


@query(f"WITH {A.FM}, c AS (SELECT batch_id, watch_dir, count(*) AS files FROM fm GROUP BY ALL) SELECT *, (sum(files) OVER (PARTITION BY watch_dir ORDER BY batch_id ROWS UNBOUNDED PRECEDING))::BIGINT AS total_files FROM c")
def directory_running_totals(spark, d):
    return windows.running_totals(aggregates.directory_counts(A.files(spark, d)), ["watch_dir"], "batch_id", ["files"])


@query(f"WITH {A.FM} SELECT sample_id, max(file_size) >= 90000000 AS passed FROM fm GROUP BY 1")
def non_empty_samples(spark, d):
    return A.files(spark, d).groupBy("sample_id").agg((F.max("file_size") >= 90_000_000).alias("passed"))


@query(f"WITH RECURSIVE {A.KR}, m AS (SELECT sample_id, (sum(cumul) FILTER (taxid IN ('0', '1')))::BIGINT AS n FROM kr GROUP BY 1), h AS (SELECT kr.*, (cumul * 20000 + n) // (n * 2) AS h FROM kr JOIN m USING (sample_id)) SELECT sample_id, row_no, concat_ws(chr(9), (h // 100) || '.' || lpad((h % 100)::VARCHAR, 2, '0'), cumul::VARCHAR, reads::VARCHAR, rank, taxid, name) AS value FROM h")
def kreport_text(spark, d):
    rows = A.report(spark, d)
    n = rows.filter("taxid in ('0', '1')").groupBy("sample_id").agg(F.sum("cumul").alias("total"))
    return sinks.kreport_lines(rows.join(n, "sample_id"), ["sample_id"])


@query("""WITH c AS (SELECT c_nationkey AS run_id, c_mktsegment || (c_custkey % 5) AS sample_id, c_acctbal AS b FROM customer), own AS (SELECT run_id, list(DISTINCT sample_id ORDER BY sample_id) AS s FROM c GROUP BY 1),
made AS (SELECT run_id, list(DISTINCT sample_id) AS m FROM c WHERE b > 9900 GROUP BY 1)
SELECT run_id, coalesce(n_name, 'now') AS started_at, array_to_string(s, ',') AS samples, array_to_string(list_sort(list_concat(list_transform(s, lambda x: x || '.report.txt'), list_transform(s, lambda x: x || '.stats.tsv'))), ',') AS files,
  CASE WHEN m IS NOT NULL THEN array_to_string(list_filter(s, lambda x: NOT list_contains(m, x)), ',') WHEN n_name IS NOT NULL THEN 'old' END AS failed
FROM own LEFT JOIN made USING (run_id) LEFT JOIN (SELECT n_nationkey AS run_id, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)) p USING (run_id)""")
def run_manifest(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_nationkey").alias("run_id"), F.concat("c_mktsegment", F.col("c_custkey") % 5).alias("sample_id"), "c_acctbal")
    known = A.table(spark, d, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    old = A.table(spark, d, "nation").join(known, "n_nationkey", "left_semi").select(F.col("n_nationkey").alias("run_id"), F.col("n_name").alias("started_at"), F.array(F.lit("old")).alias("failed"))
    m = sinks.manifest(c, c.filter("c_acctbal > 9900"), [".report.txt", ".stats.tsv"], F.lit("now"), old)
    return m.select("run_id", "started_at", *(F.array_join(x, ",").alias(x) for x in ("samples", "files", "failed")))


# Streams ----------------------------------------------------------------------------------------------------------


def _stream(spark, d, name):
    """The table's files as a stream, whether the table is one file or a folder of them."""
    at = f"{d}/{name}.parquet"
    table = spark.read.parquet(at)
    if table.inputFiles()[0].endswith(f"/{name}.parquet"):
        return batches.watch(spark, d, table.schema, names=f"{name}.parquet")
    return batches.watch(spark, at, table.schema)


def _event_stream(spark, d):
    return _stream(spark, d, "events")


@query(f"WITH {A.RA} SELECT sample_id, taxid, count(*) AS n FROM ra WHERE status = 'C' GROUP BY ALL")
def stream_cumulative_equals_batch(spark, d):
    return batches.finished(batches.running_counts(A.assigned(_stream(spark, d, "lineitem")).filter("status = 'C'"), ["sample_id", "taxid"]))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_running_counts(spark, d):
    return batches.finished(batches.running_counts(_event_stream(spark, d), ["event_type"]))


@query("SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts))::BIGINT AS hour, event_type, count(*) AS n, max(value) AS most FROM events GROUP BY ALL")
def stream_hourly_windows(spark, d):
    out = batches.windowed(_event_stream(spark, d), F.col("ts"), ["event_type"], [F.count("*").alias("n"), F.max("value").alias("most")], "1 hour", "30 days")
    return batches.upserted(out, ["window_start", "event_type"]).select(F.unix_timestamp("window_start").alias("hour"), "event_type", "n", "most")


from . import inputs, results, streams  # noqa: E402, F401  register their queries, and need query()
