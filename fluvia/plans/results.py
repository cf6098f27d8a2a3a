"""Queries of result bodies, files written and read back, session figures and comparisons; the catalogue imports them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fluvia.operators import aggregates, validation, windows
from fluvia.sources import bodies, committed, formats
from fluvia.sources.staging import fresh_path

from . import adapters as A
from .catalogue import _HALF, _SNAP, query
from .inputs import _ORDER, _TOT, _totals

_LAST = bodies.LAST
_NAME = "regexp_replace(coalesce({}, 'none'), '[^A-Za-z0-9._-]', '_', 'g')"


def _fixed(x: str, places: int) -> str:
    h = f"floor({x} * {10**places} + 0.5)::BIGINT"
    return f"(({h}) // {10**places} || '.' || lpad((({h}) % {10**places})::VARCHAR, {places}, '0'))"


# Bodies -------------------------------------------------------------------------------------------------------------


def _assembled(spark, d):
    p = A.table(spark, d, "part")
    k = F.col("p_partkey")
    own = A.contigs(spark, d).withColumns({"place": F.col("name").cast("long"), "coverage": F.col("name").cast("long") % 50 / 2})
    more = p.select(k.cast("string").alias("name"), F.when(F.col("p_size") % 11 == 0, 1.0).alias("repeat"))
    bases = p.select(F.col("p_brand").alias("sample_id"), k.cast("string").alias("name"), (k % 7).alias("gc"), F.when(k % 13 == 0, 0).otherwise(16).alias("acgt"))
    return own.join(more, "name"), bases.withColumn("gc", F.when(F.col("acgt") > 0, F.col("gc")).otherwise(0))


_SHARE = "floor(sum(gc) / sum(acgt)::DOUBLE * 1000000 + 0.5) / 1000000"


@query(
    f"""WITH {A.CTG}, c AS (SELECT ctg.*, p_partkey AS place, p_partkey % 50 / 2.0::DOUBLE AS coverage, p_size % 11 = 0 AS twice, CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_partkey % 7 END AS gc, CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE 16 END AS acgt FROM ctg JOIN part ON name = p_partkey::VARCHAR),
h AS ({_HALF.format(t="ctg", id="name", n="max(length) AS n50, min(rn) AS l50")}),
s AS (SELECT sample_id, count(*) AS n, sum(length)::BIGINT AS bases, max(length) AS longest, count(*) FILTER (circular) AS rings, {_SHARE} AS gc, min(place) AS first FROM c GROUP BY 1), f AS (SELECT *, {_NAME.format('sample_id')} || '.assembly.json' AS file FROM s JOIN h USING (sample_id))
SELECT file, -1::BIGINT AS row_no, '{{"format_version":"1.0.0","sample_id":"' || sample_id || '","summary":{{"total_contigs":' || n || ',"total_length":' || bases || ',"largest_contig":' || longest || ',"n50":' || n50 || ',"l50":' || l50 || ',"circular_contigs":' || rings || CASE WHEN gc IS NULL THEN '' ELSE ',"gc_content":' || gc END || '}},"contigs":[' AS value FROM f
UNION ALL SELECT file, {_LAST}, ']}}' FROM f
UNION ALL SELECT file, place, CASE WHEN place > first THEN ',' ELSE '' END || '{{"name":"' || name || '","length":' || length || ',"coverage":' || coverage || ',"is_circular":' || circular || CASE WHEN twice THEN ',"repeat_fraction":1.0' ELSE '' END || CASE WHEN acgt > 0 THEN ',"gc_content":' || (floor(c.gc / 16.0::DOUBLE * 1000000 + 0.5) / 1000000) ELSE '' END || '}}' FROM c JOIN f USING (sample_id)"""
)
def assembly_bodies(spark, d):
    return bodies.assembly_lines(*_assembled(spark, d))


@query(
    f"""WITH {A.READS}, q AS (SELECT sample_id, count(*) AS n, sum(length(sequence))::BIGINT AS bases, floor(sum(length(sequence)) / count(*)::DOUBLE + 0.5) AS mean, max(length(sequence)) AS longest, (count(*) % 97) / 128.0::DOUBLE AS r FROM reads GROUP BY 1)
SELECT {_NAME.format('sample_id')} || '.qc.json' AS file, 0::BIGINT AS row_no, '{{"format_version":"1.0.0","sample_id":"' || sample_id || '","before_filtering":null,"after_filtering":{{"total_reads":' || n || ',"total_bases":' || bases || ',"q20_rate":' || floor(r * 1000000 + 0.5) / 1000000 || ',"q30_rate":0.25,"gc_content":0.5,"mean_length":' || mean || ',"n50":' || longest || '}}}}' AS value FROM q"""
)
def qc_bodies(spark, d):
    n = F.length("sequence")
    s = A.reads(spark, d).groupBy("sample_id").agg(F.count("*").alias("num_seqs"), F.sum(n).alias("sum_len"), F.floor(F.sum(n).cast("double") / F.count("*") + 0.5).cast("double").alias("avg_len"), F.max(n).cast("long").alias("n50"))
    return bodies.qc_lines(bodies.seqkit_qc(s.withColumns({"q20": F.col("num_seqs") % 97 / F.lit(128.0), "q30": F.lit(0.25), "gc": F.lit(0.5)})))


@query(
    f"""WITH {A.MAP}, {_TOT}, best AS (SELECT * FROM mp WHERE evalue < 6.5e-12 QUALIFY row_number() OVER (PARTITION BY sample_id, taxid, qname ORDER BY {_ORDER}) = 1),
hs AS (SELECT sample_id, taxid, count(*) AS hits, avg(identity) AS avg_identity, avg(qcovs) / 100.0::DOUBLE AS avg_coverage FROM best GROUP BY ALL),
s AS (SELECT sample_id, taxid, total_reads, coalesce(hits, 0) AS hits, coalesce(hits, 0) / total_reads::DOUBLE AS hit_rate, coalesce(avg_identity, 0) AS avg_identity, coalesce(avg_coverage, 0) AS avg_coverage FROM tot LEFT JOIN hs USING (sample_id, taxid)),
v AS (SELECT *, CASE WHEN hit_rate >= 0.5 AND avg_identity >= 90 AND hits >= 10 THEN 'confirmed' WHEN hit_rate >= 0.25 OR avg_identity >= 81 THEN 'uncertain' ELSE 'rejected' END AS status FROM s)
SELECT sample_id || '.tsv' AS file, -1::BIGINT AS row_no, array_to_string({list(bodies.TABLE)}, chr(9)) AS value FROM (SELECT DISTINCT sample_id FROM v)
UNION ALL SELECT sample_id || '.tsv', taxid::BIGINT, concat_ws(chr(9), sample_id, taxid, '', 'blast', total_reads::VARCHAR, hits::VARCHAR, {_fixed('hit_rate', 4)}, {_fixed('avg_identity', 2)}, {_fixed('avg_coverage', 4)}, status) FROM v"""
)
def validation_tables(spark, d):
    v = validation.blast_stats(A.mappings(spark, d).filter("evalue < 6.5e-12"), _totals(spark, d), ["sample_id", "taxid"], _ORDER.split(", "))
    v = v.withColumns({"species": F.lit(None).cast("string"), "method": F.lit("blast"), "kraken_reads": F.col("total_reads")})
    return bodies.validation_lines(v, F.col("taxid").cast("long"), F.concat("sample_id", F.lit(".tsv")))


# Files written, committed and read back in splits ---------------------------------------------------------------------


@query(f"WITH {A.READS} SELECT {_NAME.format('sample_id')} AS sample_id, read_id, md5(sequence) AS sequence, md5(quality) AS quality FROM reads")
def fastq_files_read_back(spark, d):
    path = fresh_path(spark, "fastq")
    committed.write(bodies.fastq_lines(A.reads(spark, d)), path)
    got = formats.fastq(spark, path)
    return got.select(F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("sample_id"), "read_id", F.md5("sequence").alias("sequence"), F.md5("quality").alias("quality"))


# Sessions and comparisons ---------------------------------------------------------------------------------------------

_AT = "ba AS (SELECT batch_id, max(epoch_us(ts) // 1000)::BIGINT AS at_ms FROM fm JOIN events USING (event_id) GROUP BY 1)"


def _snapshots(spark, d):
    when = A.table(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    files = A.files(spark, d).join(when, "event_id")
    return aggregates.snapshot(files, ["batch_id"]).join(files.groupBy("batch_id").agg(F.max("ms").alias("at_ms")), "batch_id")


def _near(x: str, places: int = 2) -> str:
    return f"floor(({x}) * {10**places} + 0.5) / {10**places}"


@query(f"""WITH {A.FM}, {_SNAP}, {_AT}, w AS (SELECT batch_id, row_number() OVER o AS nb, sum(files) OVER o AS f, sum(total_bytes) OVER o AS b, (sum(round(total_mb * 100)::BIGINT) OVER o)::DOUBLE / 100.0::DOUBLE AS mb, sum(reads) OVER o AS r, sum(compressed) OVER o AS c, (at_ms - first_value(at_ms) OVER o)::DOUBLE / 1000.0::DOUBLE AS s FROM sn JOIN ba USING (batch_id) WINDOW o AS (ORDER BY batch_id ROWS UNBOUNDED PRECEDING))
SELECT batch_id, nb AS total_batches, f::BIGINT AS total_files, b::BIGINT AS total_bytes, mb AS total_mb, r::BIGINT AS total_reads, c::BIGINT AS total_compressed, {_near('s')} AS duration_seconds,
{_near('CASE WHEN s > 0 THEN f::DOUBLE / s ELSE 0 END')} AS files_per_second, {_near('CASE WHEN s > 0 THEN mb / s ELSE 0 END')} AS mb_per_second, {_near('CASE WHEN s > 0 THEN r::DOUBLE / s ELSE 0 END', 0)} AS reads_per_second, {_near('CASE WHEN s > 0 THEN nb::DOUBLE / s * 60.0::DOUBLE ELSE 0 END')} AS batches_per_minute,
{_near('f::DOUBLE / nb')} AS files_per_batch, {_near('mb / nb')} AS mb_per_batch, {_near('r::DOUBLE / nb', 0)} AS reads_per_batch, {_near('mb / f::DOUBLE')} AS mb_per_file FROM w""")
def session_report(spark, d):
    return aggregates.session_report(_snapshots(spark, d))


@query(f"WITH {A.FM}, {_SNAP}, {_AT}, t AS (SELECT batch_id, " + ", ".join(f"list({c}) OVER o AS {k}" for k, c in aggregates.TRENDS.items()) + " FROM sn JOIN ba USING (batch_id) WINDOW o AS (ORDER BY batch_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)) SELECT batch_id, " + ", ".join(f"len({k}) AS n_{k}, list_first({k})::DOUBLE AS first_{k}, list_last({k})::DOUBLE AS last_{k}, {k}[greatest(len({k}) // 2, 1)]::DOUBLE AS mid_{k}" for k in aggregates.TRENDS) + " FROM t")
def session_trends(spark, d):
    """Of each trend its length and first, middle and last value."""
    t = aggregates.session_trends(_snapshots(spark, d))
    at = lambda k, i: F.element_at(k, i).cast("double")
    some = lambda k: [F.size(k).cast("long").alias(f"n_{k}"), at(k, F.lit(1)).alias(f"first_{k}"), at(k, F.lit(-1)).alias(f"last_{k}"), at(k, F.greatest(F.floor(F.size(k) / 2).cast("int"), F.lit(1))).alias(f"mid_{k}")]
    return t.select("batch_id", *(c for k in aggregates.TRENDS for c in some(k)))


@query("""WITH t AS (SELECT p_brand AS component, CASE WHEN p_size < 17 THEN 'P0' WHEN p_size < 34 THEN 'P1' ELSE 'P2' END AS priority, p_partkey % 3 = 0 AS hit FROM part),
l AS (SELECT component, priority, hit FROM t UNION ALL SELECT component, 'all', hit FROM t UNION ALL SELECT 'all', 'P0+P1', hit FROM t WHERE priority IN ('P0', 'P1') UNION ALL SELECT 'all', 'all', hit FROM t)
SELECT component, priority, count(*) AS tests, count(*) FILTER (hit) AS covered, count(*) FILTER (hit) / count(*)::DOUBLE * 100 AS percent FROM l GROUP BY ALL""")
def coverage_totals(spark, d):
    p = A.table(spark, d, "part").select(F.col("p_brand").alias("component"), F.when(F.col("p_size") < 17, "P0").when(F.col("p_size") < 34, "P1").otherwise("P2").alias("priority"), (F.col("p_partkey") % 3 == 0).alias("hit"))
    return aggregates.coverage(p)


@query("""WITH r AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT c_custkey AS k, c_acctbal::DOUBLE AS x FROM customer WHERE c_acctbal > 0), t AS (SELECT c_custkey AS k, c_nationkey::BIGINT AS z FROM customer WHERE c_nationkey < 20)
SELECT k AS sample_id, 'fastp' AS tool, n AS reads, x AS side, z AS stats FROM r JOIN s USING (k) JOIN t USING (k) UNION ALL SELECT k, 'chopper', n, NULL, z FROM r JOIN t USING (k) UNION ALL SELECT k, 'trimmed', n, x, NULL FROM r FULL JOIN s USING (k)""")
def qc_tool_records(spark, d):
    c = A.table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_acctbal").cast("double").alias("x"), F.col("c_nationkey").cast("long").alias("z"))
    r = A.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("sample_id")).agg(F.count("*").alias("n"))
    s, t = c.filter("x > 0").select("sample_id", "x"), c.filter("z < 20").select("sample_id", "z")
    flat = lambda q: q.select("sample_id", "tool", F.col("reads.n").alias("reads"), (F.col("side.x") if dict(q.dtypes)["side"] != "void" else F.lit(None).cast("double")).alias("side"), (F.col("stats.z") if dict(q.dtypes)["stats"] != "void" else F.lit(None).cast("long")).alias("stats"))
    return flat(aggregates.qc_records("fastp", "general", r, s, t)).unionByName(flat(aggregates.qc_records("chopper", "long reads", r, stats=t))).unionByName(flat(aggregates.qc_records("trimmed", "long reads", r, s, optional=True)))


@query(f"WITH {A.READS} SELECT read_id, array_to_string(list_transform(range(0, greatest(length(sequence), 1), 70), lambda i: sequence[i + 1:i + 70]), chr(10)) AS lines FROM reads")
def wrapped_sequences(spark, d):
    return A.reads(spark, d).select("read_id", windows.wrapped(F.col("sequence")).alias("lines"))
