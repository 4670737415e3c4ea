"""Quality rules: a table of thresholds compiled into one projection.

Everything is a built-in expression over one row; nothing is shuffled. Words
are runs of ``[^\\x20\\x09-\\x0D]``, lines are split at ``\\n``. A null text is
treated as an empty one: it has no words, fails the base rule and is not kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_BLANK = " \t\n\x0b\x0c\r"
_SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "on", "with", "as", "was", "by", "at", "from", "are", "this",
    "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "dans", "pour", "sur", "avec", "par", "au",
    "der", "die", "das", "und", "den", "von", "zu", "dem", "ist", "nicht", "ein", "eine", "sich", "auf", "als",
    "el", "los", "las", "y", "se", "su", "con", "no", "es", "al", "lo", "para", "del",
)


@dataclass(frozen=True)
class Rule:
    """A document passes if the measure lies between the bounds, both included."""

    measure: str
    least: float | None = None
    most: float | None = None


#: Length, symbols, stop words, lines.
RULES = (
    Rule("words", 50, 1_000_000),
    Rule("repeat_ratio", None, 0.5),
    Rule("mean_word_chars", 2, 15),
    Rule("symbol_ratio", None, 0.25),
    Rule("mark_ratio", None, 0.25),
    Rule("stop_ratio", 0.01, None),
    Rule("dup_line_ratio", None, 0.5),
)


def counted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Each row of ``docs`` as the struct ``_row``, its words ``_w`` and lines ``_lines``, and counts of both."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    trimmed = F.btrim(text, F.lit(_BLANK))
    none = F.array().cast("array<string>")
    words = F.when(trimmed == "", none).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    split = docs.select(whole, text.alias("_t"), words.alias("_w"))
    n = F.size("_w")
    return split.select(
        "_row", "_w", n.cast("long").alias("_n"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit("!!")).cast("long").alias("n_marks"),
        F.filter(F.split("_t", "\n", -1), lambda line: F.btrim(line, F.lit(_BLANK)) != "").alias("_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        F.expr("cast(pow(2, ceil(log2(greatest(size(_w), 2)))) as bigint)").alias("_room"),
    )


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Each row of ``docs`` as the struct ``_row``, and the counts that the rules use as ``_m``.

    Three-word windows are compared exactly: their hashes, with the position in
    the low bits, are sorted; only windows whose hash has an equal neighbour
    are built as text and compared again. That is n log n for one text of n
    words, whatever it repeats.
    """
    carried = ["_row", "_n", "word_chars", "n_symbols", "n_marks", "n_stop"]
    mask = F.col("_room") - 1

    def packed(i: Column) -> Column:
        window = F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
        return window.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))

    hashed = counted(docs, text_column).select(
        *carried, "_w", "_room",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.col("_n") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), (F.col("_n") - 3).cast("int")), packed))
        ).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )

    def near(x: Column, i: Column) -> Column:
        def alike(other: Column) -> Column:
            return F.coalesce(x.bitwiseXOR(other).between(F.lit(0), mask), F.lit(False))

        return ((i > 0) & alike(F.get("_h", i - 1))) | alike(F.get("_h", i + 1))

    carried += ["n_lines", "n_dup_lines"]
    likely = hashed.select(
        *carried, "_w", F.transform(F.filter("_h", near), lambda x: x.bitwiseAND(mask).cast("int")).alias("_p")
    )
    built = likely.select(*carried, F.sort_array(F.transform("_p", lambda p: F.struct(
        F.concat_ws(" ", F.get("_w", p), F.get("_w", p + 1), F.get("_w", p + 2)).alias("g"), p.alias("p")
    ))).alias("_g"))

    def same(x: Column, i: Column) -> Column:
        def alike(other: Column) -> Column:
            return F.coalesce(x["g"] == other["g"], F.lit(False))

        return ((i > 0) & alike(F.get("_g", i - 1))) | alike(F.get("_g", i + 1))

    placed = built.select(*carried, F.sort_array(F.transform(F.filter("_g", same), lambda x: x["p"])).alias("_p"))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda a, p: F.struct((a["n"] + 3 - F.greatest(F.lit(0), a["e"] - p)).alias("n"), (p + 3).alias("e")),
        lambda a: a["n"].cast("long"),
    )
    counts = ["word_chars", "n_symbols", "n_marks", "n_stop", "n_lines", "n_dup_lines"]
    # A filter on the counts would be pushed below the projections that make them and
    # repeat their work inside it; a field that depends on the task keeps it above.
    here = F.monotonically_increasing_id().alias("here")
    return placed.select("_row", F.struct(F.col("_n").alias("n_words"), *counts, covered.alias("n_repeat_words"), here).alias("_m"))


def _measures() -> dict[str, Column]:
    m = {c: F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_marks", "n_stop", "n_lines", "n_dup_lines", "n_repeat_words")}
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "words": m["n_words"],
        "repeat_ratio": m["n_repeat_words"] / words,
        "mean_word_chars": m["word_chars"] / words,
        "symbol_ratio": m["n_symbols"] / words,
        "mark_ratio": m["n_marks"] / words,
        "stop_ratio": m["n_stop"] / words,
        "dup_line_ratio": m["n_dup_lines"] / lines,
    }


def broken(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the measures out of bounds, by the table."""
    values = _measures()
    found = []
    for rule in rules:
        value = values[rule.measure]
        fails = F.lit(False)
        if rule.least is not None:
            fails = fails | (value < rule.least)
        if rule.most is not None:
            fails = fails | (value > rule.most)
        found.append(F.when(fails, F.lit(rule.measure)))
    return F.array_compact(F.array(*found))


def base_failed() -> Column:
    words, repeated = F.col("_m.n_words"), F.col("_m.n_repeat_words")
    return (words < 50) | (100 * repeated > 50 * words)


def kept(rules: Sequence[Rule] = RULES) -> Column:
    return ~base_failed() & (F.size(broken(rules)) == 0)


def filtered(docs: DataFrame, text_column: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that the base rule and the table keep."""
    return measured(docs, text_column).where(kept(rules)).select("_row.*")


def summary(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    return measured(docs.select("doc_id", "text")).select(
        "_row.doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        base_failed().alias("base_failed"),
        kept(rules).alias("kept"),
        F.array_join(broken(rules), ",").alias("failed_rules"),
    )


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), grams AS (
  SELECT doc_id, p, array_to_string(w[p : p + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM split WHERE len(w) >= 3)
), repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words FROM (
    SELECT doc_id, unnest([p, p + 1, p + 2]) AS q
    FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c >= 2
  ) GROUP BY doc_id
), counted AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(regexp_extract_all(t, '!!')) AS BIGINT) AS n_marks,
         CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(r.n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeated r ON r.doc_id = s.doc_id
), ratios AS (
  SELECT *, greatest(n_words, 1) AS nw, greatest(n_lines, 1) AS nl, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counted
), judged AS (
  SELECT *, concat_ws(',',
    CASE WHEN n_words < 50 OR n_words > 1000000 THEN 'words' END,
    CASE WHEN n_repeat_words / nw > 0.5 THEN 'repeat_ratio' END,
    CASE WHEN word_chars / nw < 2 OR word_chars / nw > 15 THEN 'mean_word_chars' END,
    CASE WHEN n_symbols / nw > 0.25 THEN 'symbol_ratio' END,
    CASE WHEN n_marks / nw > 0.25 THEN 'mark_ratio' END,
    CASE WHEN n_stop / nw < 0.01 THEN 'stop_ratio' END,
    CASE WHEN n_dup_lines / nl > 0.5 THEN 'dup_line_ratio' END) AS failed_rules
  FROM ratios
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
""".replace("{stop}", ", ".join(f"'{w}'" for w in STOP_WORDS))
