"""Quality rules: a threshold table compiled into one projection of built-in functions.

RULES names ratios of a document's counts with the least and greatest value allowed (None: no bound); compiled()
turns the table into one boolean expression. All counts are of whole texts and stay in the JVM: no user functions,
no shuffle. Repeated 5-word windows are first looked for by their hashes; only where two hashes agree are the windows
themselves sorted and compared, so the count is exact.

Defined cases: a null or empty text has no words and no lines, all counts 0, and is not kept; ratios whose
denominator is 0 count as 0; repeated rows get one row each; a null id stays null. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, read_table

#: The symbols counted, and frequent function words of English, German, French and Spanish.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a and are as at be by for from in is it of on or that the this to was with "
    "an auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
    "au dans de des du elle en est et il la le les par pas pour que qui sur un une "
    "con del el en es la las lo los no para por que se su un una y"
).split()

#: (ratio, least, greatest).
RULES = [
    ("mean_word_length", 2.0, 15.0),
    ("symbols_per_word", None, 0.1),
    ("exclamations_per_word", None, 0.5),
    ("stop_word_ratio", 0.02, None),
    ("duplicate_line_ratio", None, 0.5),
]
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
SPACE = r"[\x20\x09-\x0D]+"


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_length": lambda: _ratio(F.col("word_chars"), F.col("n_words")),
    "symbols_per_word": lambda: _ratio(F.col("n_symbols"), F.col("n_words")),
    "exclamations_per_word": lambda: _ratio(F.col("n_exclamations"), F.col("n_words")),
    # A very short text may do without function words.
    "stop_word_ratio": lambda: F.when(F.col("n_words") >= 20, F.col("n_stop_words") / F.col("n_words")).otherwise(F.lit(1.0)),
    "duplicate_line_ratio": lambda: _ratio(F.col("n_dup_lines"), F.col("n_lines")),
}


def compiled(rules: list[tuple[str, float | None, float | None]] = RULES) -> Column:
    """True where every ratio is within its bounds."""
    out = F.lit(True)
    for name, least, greatest in rules:
        ratio = RATIOS[name]()
        if least is not None:
            out = out & (ratio >= least)
        if greatest is not None:
            out = out & (ratio <= greatest)
    return out


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_windows(words: Column, hashes: Column, size: int = WINDOW) -> Column:
    """The sorted windows (w, at) of `size` words where two hashes agree, else null."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, size)).alias("w"), i.alias("at")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(windows))


def repeat_words(windows: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows that the text has twice or more. windows: a column, as it is read from lambdas."""
    same = lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))
    twice = F.filter(windows, lambda x, i: same(x, F.get(windows, i - 1)) | same(x, F.get(windows, i + 1)))
    starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
    start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(starts, start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(size), x - a["last"])).alias("n")), lambda a: a["n"])
    return F.coalesce(covered, F.lit(0))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that the rules are made of, one row per row of docs."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.select("*", F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    words = F.col("words")
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    docs = docs.select("*", F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")).alias("hashes"))
    docs = docs.select("*", repeated_windows(words, F.col("hashes")).alias("windows"))
    return docs.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _count_of(F.col("text"), "!").cast("long").alias("n_exclamations"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*dict.fromkeys(STOP_WORDS)))).cast("long").alias("n_stop_words"),
    )


def judge(docs: DataFrame, rules: list[tuple[str, float | None, float | None]] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """measure() with base_failed (too short or too repetitive) and kept."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return measure(docs, id_col, text_col).select("*", failed.alias("base_failed"), (~failed & compiled(rules)).alias("kept"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
t AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, sum(least(5, i - last)) AS n FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -9) AS last FROM t) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(lines)::BIGINT AS n_lines, length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations,
             len(list_filter(words, lambda x: list_contains([{stop}], lower(x))))::BIGINT AS n_stop_words
      FROM w LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND word_chars / n_words >= 2.0 AND word_chars / n_words <= 15.0 AND n_symbols / n_words <= 0.1
       AND n_exclamations / n_words <= 0.5 AND (n_words < 20 OR n_stop_words / n_words >= 0.02) AND n_dup_lines / n_lines <= 0.5 AS kept FROM f
""".replace("{stop}", ", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS)))
