"""Queries of inputs, checks and read statistics; the catalogue imports them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluvia.functions.scalars import basename
from fluvia.operators import aggregates, inputs, joins, reads, scores, trimming, validation
from fluvia.sources import sinks

from . import adapters as A
from .catalogue import query

_READ = r"regexp_matches(path, '\.(fastq|fq)(\.gz)?$')"
_SHOWN = _READ + " AND NOT starts_with(split_part(path, '/', -1), '.')"
_PARENT = "split_part(path, '/', -2)"


@query(rf"WITH {A.PATHS} SELECT CASE WHEN regexp_matches({_PARENT}, '^barcode\d+$') THEN regexp_replace(path, '/?[^/]*/[^/]*$', '') ELSE regexp_replace(path, '/?[^/]*$', '') END AS root, CASE WHEN bool_or({_READ} AND regexp_matches({_PARENT}, '^barcode\d+$')) THEN 'barcode_subdirs' ELSE 'flat' END AS structure FROM paths GROUP BY 1")
def input_structure(spark, d):
    return inputs.structure(A.paths(spark, d))


@query(rf"WITH {A.PATHS} SELECT {_PARENT} AS sample_id, count(DISTINCT path) AS n_files, string_agg(DISTINCT path, ',' ORDER BY path) AS files FROM paths WHERE {_SHOWN} AND (regexp_matches({_PARENT}, '^barcode\d+$') OR {_PARENT} = 'unclassified') GROUP BY 1")
def barcode_folder_samples(spark, d):
    return inputs.barcode_samples(A.paths(spark, d)).withColumn("files", F.array_join("files", ","))


@query(rf"WITH {A.PATHS} SELECT regexp_replace(split_part(path, '/', -1), '\.(fastq|fq)(\.gz)?$', '') AS sample_id, count(DISTINCT path) AS n_files, string_agg(DISTINCT path, ',' ORDER BY path) AS files FROM paths WHERE {_SHOWN} GROUP BY 1")
def flat_folder_samples(spark, d):
    return inputs.flat_samples(A.paths(spark, d)).withColumn("files", F.array_join("files", ","))


@query(f"WITH {A.PATHS}, n AS (SELECT path, split_part(path, '/', -1) AS f FROM paths), k AS (SELECT path, CASE WHEN f LIKE '%.fastq.gz' THEN 'packed' WHEN f LIKE '%.fastq' THEN 'plain' END AS kind, CASE WHEN f LIKE '%.fastq.gz' THEN f[:-10] WHEN f LIKE '%.fastq' THEN f[:-7] END AS sample_id FROM n) SELECT sample_id, min(path) FILTER (kind = 'plain') AS plain, min(path) FILTER (kind = 'packed') AS packed FROM k WHERE kind IS NOT NULL GROUP BY 1")
def suffix_pairs(spark, d):
    return inputs.pair_by_suffix(A.paths(spark, d), {"plain": ".fastq", "packed": ".fastq.gz"})


@query(f"WITH {A.PATHS} SELECT {_PARENT} AS folder, bool_or(file_id * 7 % 60 >= 50) AS passed FROM paths GROUP BY 1")
def folders_with_data(spark, d):
    files = A.paths(spark, d).select(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder"), (F.col("file_id") * 7 % 60).alias("size"))
    return inputs.non_empty(files, ["folder"])


@query("SELECT c_nationkey AS sample_id, count(DISTINCT c_mktsegment) AS kinds FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1")
def uneven_samples(spark, d):
    return inputs.uneven_samples(A.table(spark, d, "customer").select(F.col("c_nationkey").alias("sample_id"), "c_mktsegment"), "sample_id", "c_mktsegment")


@query("SELECT o_orderkey AS run_id, CASE WHEN (o_orderkey % 2 = 0)::INT + (o_orderkey % 3 = 0)::INT + (o_orderkey % 5 = 0)::INT > 1 THEN 'several' WHEN o_orderkey % 2 = 0 THEN 'sheet' WHEN o_orderkey % 3 = 0 THEN 'folder' WHEN o_orderkey % 5 = 0 THEN 'barcodes' ELSE 'none' END AS mode FROM orders")
def input_mode(spark, d):
    k = F.col("o_orderkey")
    return A.table(spark, d, "orders").select(k.alias("run_id"), inputs.input_mode({"sheet": k % 2 == 0, "folder": k % 3 == 0, "barcodes": k % 5 == 0}).alias("mode"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 6 = 0 THEN 'ok' WHEN l_partkey % 6 IN (1, 2) THEN 'drop' WHEN l_linenumber <= 2 THEN 'retry' ELSE 'fail' END AS outcome FROM lineitem")
def task_outcomes(spark, d):
    return A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", inputs.task_outcome(F.col("l_partkey") % 6, F.col("l_linenumber")).alias("outcome"))


@query("WITH b AS (SELECT p_brand, p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'other' || p_partkey ELSE 'batch_' || (p_partkey * 7 % 1000) END AS name FROM part) SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY TRY_CAST(nullif(regexp_extract(name, 'batch_(\\d+)', 1), '') AS BIGINT) NULLS LAST, name, p_partkey) AS place FROM b")
def batches_in_order(spark, d):
    k = F.col("p_partkey")
    name = F.when(k % 9 == 0, F.concat(F.lit("other"), k)).otherwise(F.concat(F.lit("batch_"), k * 7 % 1000))
    rows = A.table(spark, d, "part").select("p_brand", "p_partkey", name.alias("name"))
    # Names can repeat: the key, as text of equal width, settles them.
    return inputs.in_batch_order(rows.withColumn("name", F.concat("name", F.lit(" "), F.lpad(k.cast("string"), 12, "0"))), ["p_brand"], "name").select("p_partkey", "place")


@query("WITH l AS (SELECT n_regionkey, list(n_name ORDER BY n_name) AS s FROM nation GROUP BY 1) SELECT n_regionkey, array_to_string(s[:3], ', ') || CASE WHEN len(s) > 3 THEN ' and ' || (len(s) - 3) || ' more' ELSE '' END AS shown FROM l")
def first_and_more(spark, d):
    own = A.table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("s"))
    return own.select("n_regionkey", inputs.first_and_more(F.col("s"), 3).alias("shown"))


@query("WITH t AS (SELECT event_id, floor(epoch(ts) / 3600)::BIGINT AS tick FROM events) SELECT event_id, tick, ((row_number() OVER (PARTITION BY tick ORDER BY event_id) - 1) // 4)::BIGINT AS batch_in_tick FROM t")
def count_or_timer_batches(spark, d):
    return inputs.count_or_timer_batches(A.table(spark, d, "events"), "ts", "event_id", 4, 3600).select("event_id", "tick", "batch_in_tick")


@query("SELECT event_id FROM events WHERE ts <= (SELECT min(ts) FROM events) + INTERVAL 7 DAY")
def stop_on_time_budget(spark, d):
    e = A.table(spark, d, "events").select("event_id", "ts")
    return inputs.within_budget(e, "ts", 7 * 24 * 60 - 30, 30).select("event_id")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d_%H-%M-%S') AS path_time, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso_time FROM events")
def time_formats(spark, d):
    return A.table(spark, d, "events").select("event_id", inputs.path_time(F.col("ts")).alias("path_time"), inputs.iso_time(F.col("ts")).alias("iso_time"))


@query(f"WITH {A.RA}, {A.ALN}, e AS (SELECT sample_id, taxid, count(*) AS extracted FROM ra WHERE status = 'C' GROUP BY ALL), t AS (SELECT sample_id, taxid, count(*) AS total_reads FROM aln GROUP BY ALL) SELECT t.*, coalesce(extracted, total_reads) AS extracted FROM t LEFT JOIN e USING (sample_id, taxid)")
def extraction_lookup(spark, d):
    stats = A.alignments(spark, d).groupBy("sample_id", "taxid").agg(F.count("*").alias("total_reads"))
    counts = validation.taxid_histogram(A.read_assignment(spark, d)).withColumnRenamed("n", "extracted")
    return inputs.with_fallback(stats, counts, ["sample_id", "taxid"], "extracted", "total_reads")


@query("SELECT o_orderkey AS read_id, o_orderpriority AS sequence FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def contaminant_reads_removed(spark, d):
    own = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("read_id"), F.col("o_orderpriority").alias("sequence"))
    return inputs.without(own, A.table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("read_id")), "read_id")


@query(f"WITH {A.FM} SELECT count(*) AS files, count(DISTINCT batch_id) AS batches, count(DISTINCT sample_id) AS barcodes, min(priority_score) AS min_priority, max(priority_score) AS max_priority, min(file_size) AS min_size, max(file_size) AS max_size FROM fm")
def run_snapshot(spark, d):
    return inputs.run_snapshot(A.files(spark, d))


@query(f"WITH {A.RA}, b AS (SELECT sample_id, batch_id, count(*) AS n, count(*) FILTER (status = 'C') AS c FROM ra GROUP BY ALL), h AS (SELECT *, (c * 20000 + n) // (n * 2) AS h FROM b) SELECT sample_id, batch_id, (h // 100) || '.' || lpad((h % 100)::VARCHAR, 2, '0') AS percent FROM h")
def classification_rates(spark, d):
    b = A.read_assignment(spark, d).groupBy("sample_id", "batch_id").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "C").alias("c"))
    return b.select("sample_id", "batch_id", sinks.percent_text(F.col("c"), F.col("n")).alias("percent"))


@query(f"WITH {A.READS}, g AS (SELECT sample_id, read_id AS name, length(regexp_replace(sequence, '[^GCgc]', '', 'g'))::BIGINT AS gc, length(regexp_replace(sequence, '[^ACGTacgt]', '', 'g'))::BIGINT AS acgt FROM reads) SELECT sample_id, name, gc, acgt, CASE WHEN acgt > 0 THEN gc / acgt::DOUBLE END AS gc_fraction FROM g")
def contig_gc(spark, d):
    return reads.contig_gc(A.reads(spark, d).withColumnRenamed("read_id", "name"), ["sample_id", "name"])


_N = "length(regexp_replace({c}, '[^{k}]', '', 'g'))"


@query(f"WITH {A.READS} SELECT sample_id, sum({_N.format(c='quality', k='5-~')})::BIGINT AS q20_bases, sum({_N.format(c='quality', k='?-~')})::BIGINT AS q30_bases, sum({_N.format(c='sequence', k='Nn')})::BIGINT AS sum_n, sum({_N.format(c='sequence', k='. -')})::BIGINT AS sum_gap, sum({_N.format(c='sequence', k='GCgc')})::BIGINT AS gc_bases, sum({_N.format(c='quality', k='5-~')}) * 100 / sum(length(quality))::DOUBLE AS q20, sum({_N.format(c='quality', k='?-~')}) * 100 / sum(length(quality))::DOUBLE AS q30, sum({_N.format(c='sequence', k='GCgc')}) * 100 / sum(length(sequence))::DOUBLE AS gc FROM reads GROUP BY 1")
def read_quality_stats(spark, d):
    return reads.quality_stats(A.reads(spark, d), ["sample_id"])


@query(f"WITH {A.READS}, q AS (SELECT sample_id, read_id, -10 * log10(list_sum(list_transform(list_filter(string_split(quality, ''), lambda c: c <> ''), lambda c: pow(10.0, (ascii(c) - 33) / -10.0))) / length(quality)) AS q FROM reads WHERE length(sequence) >= 1000) SELECT sample_id, read_id FROM q WHERE q >= 33.3")
def mean_error_filter(spark, d):
    return reads.filter_reads(A.reads(spark, d), reads.ReadFilter(33.3, 1000)).select("sample_id", "read_id")


@query(f"WITH {A.ALN}, best AS (SELECT * FROM aln WHERE mapq >= 10 QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY tstart, tend, identity, mapq, tname) = 1) SELECT sample_id, taxid, count(*) AS hits, sum(mapq)::DOUBLE / count(*) AS avg_mapq, sum(tend - tstart)::DOUBLE / sum(tlen) AS target_coverage, min(tname) AS contig, max(tlen) AS contig_length FROM best GROUP BY ALL")
def alignment_details(spark, d):
    return validation.hit_details(A.alignments(spark, d).filter("mapq >= 10"), ["sample_id", "taxid"], A.ALN_ORDER)


@query("SELECT coalesce(a.k, b.k) AS contig, n_reads, n_overlaps FROM (SELECT l_partkey AS k, count(*) AS n_reads FROM lineitem GROUP BY 1) a FULL JOIN (SELECT o_custkey AS k, count(*) AS n_overlaps FROM orders GROUP BY 1) b ON a.k = b.k")
def reads_with_overlaps(spark, d):
    a = A.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("contig")).agg(F.count("*").alias("n_reads"))
    b = A.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("contig")).agg(F.count("*").alias("n_overlaps"))
    return joins.either(a, b, ["contig"])


_ORDER = "tstart, tend, identity, mapq, tname, qstart, qcovs, evalue"
_TOT = "tot AS (SELECT l_linestatus AS sample_id, (1000 + l_suppkey)::VARCHAR AS taxid, count(*) AS total_reads FROM lineitem GROUP BY ALL)"


def _totals(spark, d):
    return A.table(spark, d, "lineitem").groupBy(F.col("l_linestatus").alias("sample_id"), (F.col("l_suppkey") + 1000).cast("string").alias("taxid")).agg(F.count("*").alias("total_reads"))


@query(f"""WITH {A.MAP}, {_TOT}, fine AS (SELECT * FROM mp WHERE mapq >= 10), ins AS (SELECT * FROM fine WHERE tend > tstart AND tend <= tlen),
best AS (SELECT * FROM fine QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY {_ORDER}) = 1),
hs AS (SELECT sample_id, taxid, count(*) AS hits, avg(mapq) AS avg_mapq, avg(identity) AS avg_identity, avg(abs(qend - qstart) / qlen::DOUBLE) AS avg_coverage FROM best GROUP BY ALL),
mk AS (SELECT *, CASE WHEN tstart <= max(tend) OVER (PARTITION BY sample_id, taxid ORDER BY tstart, tend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM ins),
il AS (SELECT *, sum(fresh) OVER (PARTITION BY sample_id, taxid ORDER BY tstart, tend ROWS UNBOUNDED PRECEDING) AS island FROM mk),
cv AS (SELECT sample_id, taxid, sum(hi - lo)::BIGINT AS covered FROM (SELECT sample_id, taxid, island, min(tstart) AS lo, max(tend) AS hi FROM il GROUP BY ALL) GROUP BY ALL),
al AS (SELECT sample_id, taxid, sum(tend - tstart)::BIGINT AS aligned FROM ins GROUP BY ALL),
lg AS (SELECT sample_id, taxid, tname AS contig, tlen AS contig_length FROM mp QUALIFY row_number() OVER (PARTITION BY sample_id, taxid ORDER BY tlen DESC, {_ORDER}) = 1),
s AS (SELECT sample_id, taxid, total_reads, coalesce(hits, 0) AS hits, coalesce(hits, 0) / total_reads::DOUBLE AS hit_rate, coalesce(avg_mapq, 0) AS avg_mapq, coalesce(avg_identity, 0) AS avg_identity, coalesce(avg_coverage, 0) AS avg_coverage,
  coalesce(covered, 0) AS covered, coalesce(aligned, 0) AS aligned, coalesce(covered, 0) / contig_length::DOUBLE AS breadth, coalesce(aligned / nullif(covered, 0)::DOUBLE, 0) AS depth, contig, contig_length
  FROM tot LEFT JOIN hs USING (sample_id, taxid) LEFT JOIN cv USING (sample_id, taxid) LEFT JOIN al USING (sample_id, taxid) LEFT JOIN lg USING (sample_id, taxid))
SELECT *, CASE WHEN hit_rate >= 0.5 AND avg_identity >= 90 AND hits >= 10 AND (breadth >= 0.05 OR (breadth <= 0.05 AND depth >= 10 AND covered >= 200)) THEN 'confirmed' WHEN hit_rate >= 0.25 OR avg_identity >= 81 THEN 'uncertain' ELSE 'rejected' END AS status FROM s""")
def mapping_verdicts(spark, d):
    return validation.mapping_stats(A.mappings(spark, d), _totals(spark, d), ["sample_id", "taxid"], _ORDER.split(", "))


@query(f"""WITH {A.MAP}, {_TOT}, best AS (SELECT * FROM mp WHERE evalue < 6.5e-12 QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY {_ORDER}) = 1),
hs AS (SELECT sample_id, taxid, count(*) AS hits, avg(identity) AS avg_identity, avg(qcovs) / 100.0::DOUBLE AS avg_coverage, min(evalue) AS min_evalue FROM best GROUP BY ALL),
s AS (SELECT sample_id, taxid, total_reads, coalesce(hits, 0) AS hits, coalesce(hits, 0) / total_reads::DOUBLE AS hit_rate, coalesce(avg_identity, 0) AS avg_identity, coalesce(avg_coverage, 0) AS avg_coverage, coalesce(min_evalue, 1) AS min_evalue FROM tot LEFT JOIN hs USING (sample_id, taxid))
SELECT *, CASE WHEN hit_rate >= 0.5 AND avg_identity >= 90 AND hits >= 10 THEN 'confirmed' WHEN hit_rate >= 0.25 OR avg_identity >= 81 THEN 'uncertain' ELSE 'rejected' END AS status FROM s""")
def blast_figures(spark, d):
    return validation.blast_stats(A.mappings(spark, d).filter("evalue < 6.5e-12"), _totals(spark, d), ["sample_id", "taxid"], _ORDER.split(", "))


_Q = "list_transform(list_filter(string_split(quality, ''), lambda c: c <> ''), lambda c: ascii(c) - 33)"


@query(f"""WITH {A.READS}, p AS (SELECT read_id, unnest({_Q}) AS q, generate_subscripts({_Q}, 1) AS pos, length(quality) AS n FROM reads),
w AS (SELECT read_id, pos, n, sum(q) OVER (PARTITION BY read_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s FROM p),
g AS (SELECT read_id, min(pos) AS lo, max(pos + least(4, n)) AS hi FROM w WHERE pos <= greatest(n - 3, 1) AND s >= least(4, n) * 70 GROUP BY 1)
SELECT sample_id, read_id, CASE WHEN lo IS NULL THEN '' ELSE substring(sequence, lo, hi - lo) END AS sequence FROM reads LEFT JOIN g USING (read_id)""")
def quality_cut_reads(spark, d):
    return reads.cut_ends(A.reads(spark, d), 70).select("sample_id", "read_id", "sequence")


@query(f"""WITH {A.READS}, m AS (SELECT sample_id, read_id, length(sequence) AS n, -10 * log10(list_sum(list_transform({_Q}, lambda x: pow(10.0, x / -10.0))) / length(quality)) AS mq FROM reads WHERE length(sequence) >= 1000),
k AS (SELECT * FROM m WHERE mq >= 9), c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY sample_id ORDER BY n DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY sample_id) AS al FROM k) SELECT sample_id, read_id FROM c WHERE before * 100 < al * 85""")
def preset_reads(spark, d):
    return reads.apply_preset(A.reads(spark, d), ["sample_id"], "metagenomics", ["sample_id", "read_id"])


@query("""WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN 'fastp' WHEN 'N' THEN 'chopper' ELSE 'filtlong' END AS tool, l_quantity > 15 AS k, l_linenumber * 3 AS q, l_discount < 0.04 AS h FROM lineitem),
c AS (SELECT tool, count(*) FILTER (k) / count(*)::DOUBLE AS retention, avg(q) FILTER (k) - avg(q) AS gain, avg(q) FILTER (k) AS q, count(*) FILTER (k AND h) * 100 / count(*) FILTER (k)::DOUBLE AS q30 FROM t GROUP BY 1)
SELECT tool, 'relax_filters' AS advice FROM c WHERE tool = 'fastp' AND retention < 0.7 UNION ALL SELECT tool, 'little_gain' FROM c WHERE tool = 'fastp' AND gain < 0.05
UNION ALL SELECT tool, 'good_default' FROM c WHERE tool = 'chopper' AND q > 12 UNION ALL SELECT tool, 'low_q30' FROM c WHERE tool = 'chopper' AND q30 < 50 AND q30 <> 0
UNION ALL SELECT NULL, unnest(['chopper_is_faster', 'prefer_native_tools']) FROM (SELECT count(DISTINCT tool) AS n FROM c WHERE tool IN ('chopper', 'fastp')) WHERE n = 2 UNION ALL SELECT NULL, unnest(['monitor_resources', 'choose_by_aim'])""")
def qc_advice_by_tool(spark, d):
    keep, q = F.col("l_quantity") > 15, F.col("l_linenumber") * 3
    tool = F.when(F.col("l_returnflag") == "A", "fastp").when(F.col("l_returnflag") == "N", "chopper").otherwise("filtlong")
    s = A.table(spark, d, "lineitem").groupBy(tool.alias("tool")).agg(
        (F.count_if(keep) / F.count("*")).alias("retention"), (F.avg(F.when(keep, q)) - F.avg(q)).alias("quality_delta"), F.avg(F.when(keep, q)).alias("quality_after"), (F.count_if(keep & (F.col("l_discount") < 0.04)) * 100 / F.count_if(keep)).alias("q30")
    )
    return aggregates.advice(s)


_SCORED = f"""WITH {A.READS}, u AS (SELECT sample_id, read_id, length(sequence) AS n, unnest(string_split(quality, '')) AS c, generate_subscripts(string_split(quality, ''), 1) AS i FROM reads WHERE sequence <> ''),
e AS (SELECT *, least({scores.UNIT}, round({scores.UNIT} * power(10::DOUBLE, (33 - ascii(c)) / 10::DOUBLE)))::BIGINT AS p FROM u),
w AS (SELECT *, sum(p) OVER (PARTITION BY read_id ORDER BY i ROWS 249 PRECEDING) AS s FROM e),
t AS (SELECT sample_id, read_id, n, sum(p)::DOUBLE AS total, max(s) FILTER (i >= least(250, n))::DOUBLE AS worst FROM w GROUP BY ALL),
q AS (SELECT sample_id, read_id, n, 100.0::DOUBLE - total / n / {scores.UNIT / 100}::DOUBLE AS mean_q, 100.0::DOUBLE - worst / least(n, 250) / {scores.UNIT / 100}::DOUBLE AS window_q FROM t),
sc AS (SELECT *, sqrt(100.0::DOUBLE * n / (n + 5000) * mean_q) * (window_q / mean_q) AS score FROM q)"""


@query(f"{_SCORED}, b AS (SELECT *, coalesce(sum(n) OVER w, 0) AS before, sum(n) OVER (PARTITION BY sample_id) AS al FROM sc WHERE n >= 200 AND window_q >= 99.5 WINDOW w AS (PARTITION BY sample_id ORDER BY score DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT sample_id, read_id, mean_q, window_q, score FROM b WHERE before < al * 0.9::DOUBLE")
def best_scored_reads(spark, d):
    own = scores.scored(A.reads(spark, d).filter("sequence <> ''"))
    return scores.keep_best(own, ["sample_id"], 90, min_length=200, min_window_q=99.5, columns=["sample_id", "read_id", "mean_q", "window_q", "score"])


@query(f"{_SCORED}, b AS (SELECT *, coalesce(sum(n) OVER w, 0) AS before FROM sc WINDOW w AS (PARTITION BY sample_id ORDER BY score DESC, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT sample_id, read_id FROM b WHERE before < 50000")
def best_reads_to_target(spark, d):
    return scores.keep_best(scores.scored(A.reads(spark, d).filter("sequence <> ''")), ["sample_id"], target=50_000, columns=["sample_id", "read_id"])


_ENDS = "GGTTACGTCCATTGCA"


@query(f"""WITH r AS (SELECT p_partkey AS read_id, repeat('A', (p_partkey % 5)::INT) || '{_ENDS[:7]}' || CASE p_partkey % 3 WHEN 0 THEN '{_ENDS[7]}' WHEN 1 THEN '' ELSE 'N' END || '{_ENDS[8:]}' AS head, repeat('N', 40 + (p_partkey % 9)::INT) AS body, CASE WHEN p_partkey % 4 = 0 THEN '{_ENDS}' || repeat('N', 60) ELSE '' END AS rest FROM part)
SELECT read_id, 1 AS piece, body AS sequence FROM r UNION ALL SELECT read_id, 2, repeat('N', 60) FROM r WHERE rest <> ''""")
def adapters_with_errors(spark, d):
    k = F.col("p_partkey")
    middle = F.when(k % 3 == 0, _ENDS[7]).when(k % 3 == 1, "").otherwise("N")
    head = F.concat(F.repeat(F.lit("A"), (k % 5).cast("int")), F.lit(_ENDS[:7]), middle, F.lit(_ENDS[8:]))
    body = F.concat(F.repeat(F.lit("N"), (k % 9 + 40).cast("int")), F.when(k % 4 == 0, _ENDS + "N" * 60).otherwise(""))
    # The table is small for what its reads take, so they are dealt to all cores before they are made.
    own = A.table(spark, d, "part").select("p_partkey").repartition(4 * spark.sparkContext.defaultParallelism).select(k.alias("read_id"), F.concat(head, body).alias("sequence"), F.concat(head, body).alias("quality"))
    return trimming.split_reads(own, [_ENDS], window=32, end_share=0.1, inner_share=0.05, least=20).select("read_id", "piece", "sequence")


_COUNT = "sum(length(regexp_replace({c}, '[^{x}]', '', 'g')))::BIGINT"
_FULL = f"""WITH {A.READS}, ln AS (SELECT sample_id, batch, read_id, sequence, quality, length(sequence) AS length FROM reads),
hf AS (SELECT sample_id, batch, max(length) AS n50, min(rn) AS n50_num FROM (SELECT *, sum(length) OVER w AS cum, sum(length) OVER (PARTITION BY sample_id, batch) AS al, row_number() OVER w AS rn FROM ln WINDOW w AS (PARTITION BY sample_id, batch ORDER BY length DESC, read_id ROWS UNBOUNDED PRECEDING)) WHERE cum * 2 >= al GROUP BY ALL),
pq AS (SELECT sample_id, batch, sum(least({scores.UNIT}, round({scores.UNIT} * power(10::DOUBLE, (33 - ascii(c)) / 10::DOUBLE)))::BIGINT)::DOUBLE / {float(scores.UNIT)}::DOUBLE / count(*) AS p FROM (SELECT sample_id, batch, unnest(string_split(quality, '')) AS c FROM ln WHERE quality <> '') GROUP BY ALL),
st AS (SELECT sample_id, batch, count(*) AS num_seqs, sum(length)::BIGINT AS sum_len, min(length)::INTEGER AS min_len, avg(length) AS avg_len, max(length)::INTEGER AS max_len, quantile_cont(length, 0.25)::DOUBLE AS q1, quantile_cont(length, 0.5)::DOUBLE AS q2, quantile_cont(length, 0.75)::DOUBLE AS q3,
  {_COUNT.format(c='quality', x='5-~')} * 100 / sum(length)::DOUBLE AS q20, {_COUNT.format(c='quality', x='?-~')} * 100 / sum(length)::DOUBLE AS q30, {_COUNT.format(c='sequence', x='GCgc')} * 100 / sum(length)::DOUBLE AS gc, {_COUNT.format(c='sequence', x='. -')} AS sum_gap, {_COUNT.format(c='sequence', x='Nn')} AS sum_n FROM ln GROUP BY ALL),
fs AS (SELECT st.*, n50, n50_num, round(log10(p) * -10, 2) AS avg_qual FROM st LEFT JOIN hf USING (sample_id, batch) JOIN pq USING (sample_id, batch))"""


def _full(spark, d):
    return scores.full_stats(A.reads(spark, d).filter("sample_id is not null and batch is not null"), ["sample_id", "batch"])


@query(f"{_FULL} SELECT * FROM fs")
def full_read_stats(spark, d):
    return _full(spark, d)


_MEAN = "sum({c} * sum_len) / sum(sum_len)"


@query(f"""{_FULL}, m AS (SELECT sample_id, sum(num_seqs)::BIGINT AS num_seqs, sum(sum_len)::BIGINT AS sum_len, min(min_len) AS min_len, max(max_len) AS max_len, sum(sum_gap)::BIGINT AS sum_gap, sum(sum_n)::BIGINT AS sum_n, {', '.join(f"{_MEAN.format(c=c)} AS {c}" for c in ('q20', 'q30', 'avg_qual', 'gc'))} FROM fs GROUP BY 1)
SELECT *, sum_len / num_seqs::DOUBLE AS avg_len, sum_len / num_seqs::DOUBLE * 0.75 AS q1, sum_len / num_seqs::DOUBLE AS q2, sum_len / num_seqs::DOUBLE * 1.5 AS q3, floor(sum_len / num_seqs::DOUBLE)::BIGINT AS n50, (num_seqs // 2)::BIGINT AS n50_num FROM m""")
def merged_read_stats(spark, d):
    return aggregates.merge_read_stats(_full(spark, d), ["sample_id"])
