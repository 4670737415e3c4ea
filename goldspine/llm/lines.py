"""Line dedup: lines that several documents hold stay in the first of them only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from goldspine.llm.keys import FP, ID, TEXT, keyed
from goldspine.sinks.staging import stage

_BLANK = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ASCII texts take the faster built-in."""
    table = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(table)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(_BLANK)))


def _lines() -> Column:
    return F.split(F.col(TEXT), "\n", -1)


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 10, min_documents: int = 2,
    counts: bool = True,
) -> DataFrame:
    """All columns of ``docs`` with the kept text, and with ``counts`` also ``_n_lines``, ``_n_dropped``.

    Columns of ``docs`` by these two names give way to the counts; without
    ``counts`` the columns are those of ``docs``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. A key
    of ``min_chars`` code points that ``min_documents`` ids hold loses all its
    lines but those in the smallest id. Null and empty texts are one empty line;
    a null id ranks before all others and counts as one id; rows that share an id are one document for
    the count; an empty table stays empty.

    Only hashes and positions of lines are shuffled for counting. Lines of a
    document that go are gathered as positions, and the texts move once, to
    meet them.
    """
    others = [c for c in docs.columns if c != text_column]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest")
    rows = keyed(docs, id_column, text_column, rest)
    exploded = rows.select(ID, FP, F.posexplode(_lines()).alias("_pos", "_line"))
    long_enough = exploded.select(ID, FP, "_pos", line_key(F.col("_line")).alias("_key")).where(
        F.char_length("_key") >= min_chars
    )
    keys = stage(long_enough.select(F.unhex(F.md5("_key")).alias("_hash"), ID, FP, "_pos"), "line-keys")
    common = (
        keys.groupBy("_hash", ID).agg(F.lit(1).alias("_one"))
        .groupBy("_hash").agg(F.count("_one").alias("_documents"), F.min(ID).alias("_first"))
        .where(F.col("_documents") >= min_documents).select("_hash", "_first")
    )
    drops = (
        keys.join(common, "_hash").where(F.col(ID) != F.col("_first"))
        .groupBy(ID, FP).agg(F.collect_set("_pos").alias("_drops"))
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_drops"))
    text = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    met = rows.join(drops, [ID, FP], "left").withColumn("_lines", _lines())
    out = met.select(
        "_rest",
        F.when(F.col("_drops").isNull(), F.col(TEXT)).otherwise(text).alias("_kept"),
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("_n_dropped"),
    )
    columns = [F.col("_kept").alias(c) if c == text_column else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]
    if not counts:
        return out.select(*columns)
    own = ("_n_lines", "_n_dropped")
    return out.select(*[c for c, name in zip(columns, docs.columns) if name not in own], *own)


def summary(docs: DataFrame) -> DataFrame:
    done = dedup_lines(docs.select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND c.first_id <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN common c ON c.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
