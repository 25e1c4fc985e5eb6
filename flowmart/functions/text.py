"""Keyword segmentation.

U1 stands in for the reference's word-segmenter UDTF with a JVM-side regex
tokenizer: lower-cased runs of letters and digits of any script, order and
repeats kept.
U2 is the dictionary mode: every dictionary term found at every position of a
text, overlapping hits included.  Positions meet the dictionary by their first two
characters, and only where some term begins so are whole terms compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions of a text that are made from one piece of it.
PIECE = 256
# characters by which positions and terms meet first
ANCHOR = 2
# Fixed value: the token pattern of the default segmenter.
WORD_PATTERN = r"[\p{L}\p{N}]+"


def split_words(text: Column | str, pattern: str = WORD_PATTERN) -> Column:
    """``array<string>`` of tokens of ``text``."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), 0)


def explode_words(df: DataFrame, text: str, out: str = "word",
                  pattern: str = WORD_PATTERN) -> DataFrame:
    """Lateral join of each row with its tokens (one row per token)."""
    return df.withColumn(out, F.explode(split_words(text, pattern)))


def _positions(df: DataFrame, text: Column, most: Column, short: Column) -> DataFrame:
    """The rows of ``df`` without the text, once per position: ``pos``, ``_ahead`` (as many characters
    from there as the longest term has) and ``_anchor``, its first ones.  With terms shorter than the
    anchor (``short``: there are some) a position has an anchor of each length."""
    pieces = (
        df.withColumn("_src", text).withColumn("_most", most).withColumn("_short", short)
        .where((F.length("_src") > 0) & (F.col("_most") > 0))
        .withColumn("_lo", F.explode(F.sequence(F.lit(0), F.length("_src") - 1, F.lit(PIECE))))
        .withColumn("_piece", F.substring("_src", F.col("_lo") + 1, F.col("_most") + PIECE - 1)))
    last = F.least(F.lit(PIECE), F.length("_src") - F.col("_lo"))
    at = pieces.withColumn("_at", F.explode(F.transform(F.sequence(F.lit(1), last), lambda p: F.struct(
        (F.col("_lo") + p).alias("pos"), F.substring("_piece", p, F.col("_most")).alias("ahead")))))
    anchors = [F.substring("_ahead", 1, n) for n in range(ANCHOR, 0, -1)]
    return (at.select(*df.columns, "_short", F.col("_at.pos").alias("pos"), F.col("_at.ahead").alias("_ahead"))
            .withColumn("_anchor", F.explode(F.when(F.col("_short"), F.array_distinct(F.array(*anchors)))
                                             .otherwise(F.array(anchors[0]))))
            .drop("_short"))


def dictionary_terms(
    df: DataFrame,
    text: str,
    dictionary: DataFrame,
    term: str = "term",
    lower: bool = True,
) -> DataFrame:
    """One row per dictionary hit: input columns + ``pos`` (1-based) + ``term``.

    Every position is joined with the dictionary's beginnings (its first two characters) and
    goes on only if terms begin so, with the lengths that those terms have; then the whole terms are
    joined.  A position costs one row however many lengths the dictionary has.  A text is first cut
    into pieces of ``PIECE`` positions (each with the characters its last terms need), so a position
    costs the same in texts of any length, and no row carries the whole text.  Whole texts are scanned.
    """
    terms = dictionary.select(F.col(term).alias("_term")).where(F.col("_term") != "").distinct()
    begin = (terms.groupBy(F.substring("_term", 1, ANCHOR).alias("_anchor"))
             .agg(F.array_sort(F.collect_set(F.length("_term"))).alias("_lens")))
    most = F.coalesce(terms.agg(F.max(F.length("_term"))).scalar(), F.lit(0))
    short = F.coalesce(terms.agg(F.min(F.length("_term"))).scalar(), F.lit(ANCHOR)) < ANCHOR
    src = F.lower(F.col(text)) if lower else F.col(text)
    cand = (_positions(df, src, most, short).join(begin, "_anchor")
            .withColumn("_len", F.explode("_lens")).where(F.length("_ahead") >= F.col("_len"))
            .select(*df.columns, "pos", F.expr("substring(_ahead, 1, _len)").alias("_sub")))
    return (cand.join(terms, cand["_sub"] == terms["_term"], "inner")
            .withColumnRenamed("_term", "term").drop("_sub"))


def register_sql_functions(spark, tz: str | None = None) -> None:
    """SQL surface (U1, F2, F3): ``LATERAL split_function(item)`` and
    ``to_date_str(ms)`` / ``to_ymd_hms(ms)`` as SQL functions.

    They are SQL-bodied, so Catalyst inlines them: the table function
    becomes a ``Generate`` of built-in expressions, no Python worker.
    """
    from flowmart.session import DEFAULT_TZ
    zone = (tz or DEFAULT_TZ).replace("'", "")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION split_function(str STRING) "
        "RETURNS TABLE (word STRING) "
        f"RETURN SELECT explode(regexp_extract_all(lower(str), r'{WORD_PATTERN}', 0)) AS word")
    local = (f"convert_timezone('UTC', '{zone}', "
             "timestampadd(MILLISECOND, ms, TIMESTAMP_NTZ'1970-01-01 00:00:00'))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION to_date_str(ms BIGINT) RETURNS STRING "
              f"RETURN date_format({local}, 'yyyy-MM-dd')")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION to_ymd_hms(ms BIGINT) RETURNS STRING "
              f"RETURN date_format({local}, 'yyyy-MM-dd HH:mm:ss')")
