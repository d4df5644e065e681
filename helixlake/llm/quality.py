"""Quality rules as one Spark projection: no user functions, no shuffle.

``RULES`` is a table of (name, metric, least, most); a text that breaks a rule is rejected. The base rules (fewer than
50 words, or more than half of the words in repeated 3-word windows) come before it.

Edge cases: a null or empty text, or one of white space alone, has no words and fails the base; texts of any length
are measured whole, each in n log n; an empty table gives no rows; repeated rows are judged alike; extra columns are
ignored, also those named like a metric.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = """
the be to of and that have with a in is it for on are as was at by from
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch
le la les de des et en un une du que est pour dans qui par sur au il
el la los las de y en que un una por con para es se del al lo no
""".split()

#: name, metric, least, most (None: no limit). A text must lie within every limit.
RULES: list[tuple[str, str, float | None, float | None]] = [
    ("words", "n_words", 50, None),
    ("mean_word_length", "mean_word_length", 2.0, 14.0),
    ("symbols_per_word", "symbol_ratio", None, 0.1),
    ("stop_words", "n_stop_words", 2, None),
    ("stop_word_ratio", "stop_word_ratio", 0.01, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
    ("words_without_letter", "no_letter_ratio", None, 0.2),
    ("upper_case_words", "upper_ratio", None, 0.5),
    ("exclamations_per_word", "exclamation_ratio", None, 0.5),
]


def metrics(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, ``row`` if there is one, and the counts that the rules are about."""
    kept = ["doc_id"] if row is None else ["doc_id", "_row"]
    docs = docs if row is None else docs.select("doc_id", "text", row.alias("_row"))
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACES + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(*kept, text.alias("text"), words.alias("words"))
    n = F.size("words")
    at = lambda i: F.element_at("words", i)
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("i"))))
    base = base.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size(F.split("text", "!", -1)) - 1).cast("long").alias("n_exclamations"),
        lines.alias("lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)))).cast("long").alias("n_upper_words"),
        F.array_sort(F.coalesce(windows, F.array().cast("array<struct<h:bigint,i:int>>"))).alias("sorted"),
    )
    # Equal windows are neighbours now. Their positions, in order, each cover three words less what the next one covers.
    h = lambda i: F.get("sorted", i)["h"]
    last = F.size("sorted") - 1
    twice = F.when(last >= 1, F.filter(F.sequence(F.lit(0), last), lambda i: ((i > 0) & (h(i) == h(i - 1))) | ((i < last) & (h(i) == h(i + 1)))))
    base = base.withColumn("twice", F.array_sort(F.coalesce(F.transform(twice, lambda i: F.get("sorted", i)["i"]), F.array().cast("array<int>"))))
    gaps = F.transform("twice", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("twice", k + 1) - x, F.lit(3))))
    return base.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
        "n_stop_words",
        "n_letter_words",
        "n_upper_words",
        "n_exclamations",
    )


def ratios() -> dict[str, Column]:
    """The rules' metrics from the counts."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "n_stop_words": F.col("n_stop_words"),
        "mean_word_length": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "no_letter_ratio": (F.col("n_words") - F.col("n_letter_words")) / F.greatest(F.col("n_words"), F.lit(1)),
        "upper_ratio": per("n_upper_words", "n_words"),
        "exclamation_ratio": per("n_exclamations", "n_words"),
    }


def compiled(rules=RULES) -> Column:
    """The threshold table as one condition."""
    have = ratios()
    limits = [have[m] >= least for _, m, least, _ in rules if least is not None] + [have[m] <= most for _, m, _, most in rules if most is not None]
    return reduce(lambda a, b: a & b, limits, F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that meet the rules, as they are."""
    # The row number is there so that the optimizer leaves the filter above the counts: pushed down to the scan, it
    # would hold every count many times over.
    counted = metrics(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns))).withColumn("_n", F.monotonically_increasing_id())
    return counted.where(~base_failed() & compiled(rules) & (F.col("_n") >= 0)).select("_row.*")


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts, base_failed and kept for every document."""
    return metrics(docs).select("*", base_failed().alias("base_failed"), (~base_failed() & compiled(rules)).alias("kept"))


def oracle_sql(rules=RULES) -> str:
    """The same result as DuckDB SQL."""
    limits = [f"{m} >= {least}" for _, m, least, _ in rules if least is not None] + [f"{m} <= {most}" for _, m, _, most in rules if most is not None]
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return f"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM documents),
    win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM a, unnest(range(1, len(w) - 1)) AS t(i)),
    rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, unnest([0, 1, 2]) AS t(k) GROUP BY doc_id),
    m AS (SELECT a.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
        len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}')))::BIGINT AS n_letter_words,
        len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x)))::BIGINT AS n_upper_words,
        length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclamations
        FROM a LEFT JOIN cov USING (doc_id)),
    r AS (SELECT *, word_chars / greatest(n_words, 1) AS mean_word_length, n_symbols / greatest(n_words, 1) AS symbol_ratio,
        n_stop_words / greatest(n_words, 1) AS stop_word_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
        (n_words - n_letter_words) / greatest(n_words, 1) AS no_letter_ratio, n_upper_words / greatest(n_words, 1) AS upper_ratio,
        n_exclamations / greatest(n_words, 1) AS exclamation_ratio,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(limits)} AS kept FROM r"""
