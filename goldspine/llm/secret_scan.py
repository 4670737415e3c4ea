"""Secret scans: an Aho-Corasick pass over whole texts, patterns anchored at its hits, then checksums.

The automaton reads a text with A-Z lower-cased and every hexadecimal digit
written as one sign, so that a run of digits is a keyword like any other. Only
where a keyword begins is its rule's pattern tried, and a match whose format
carries a checksum counts only if that is right.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from goldspine.llm.keys import FP, ID, TEXT, keyed, public_id
from goldspine.llm.tokens import chunks

_DIGIT = "0"
_FOLD = bytes(ord(_DIGIT) if chr(b) in "0123456789abcdefABCDEF" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def fold(text: str) -> str:
    """The text as the automaton sees it; every character keeps its place."""
    return text.encode().translate(_FOLD).decode()


def crc_in_base62(match: re.Match[str]) -> bool:
    """A token of a prefix, 30 characters and the CRC-32 of these as six digits of base 62."""
    body, digits = match[1][:-6], match[1][-6:]
    value = 0
    for digit in digits:
        value = value * 62 + _BASE62.index(digit)
    return len(body) == 30 and value == zlib.crc32(body.encode())


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` that begin with one of ``keywords``, left to right without overlaps.

    Of these, ``sound`` ones count. No keyword may lie inside another of its rule.
    """

    kind: str
    keywords: tuple[str, ...]
    pattern: str
    sound: Callable[[re.Match[str]], bool]

    def __post_init__(self) -> None:
        if not self.keywords or any(a != b and a in b for a in self.keywords for b in self.keywords):
            raise ValueError(f"{self.kind}: keywords must not lie inside each other")


#: Plain credentials first. The tokens after them hold a checksum of their own.
RULES = (
    Rule(
        "assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[1]) >= 6,
    ),
    Rule("access", ("AKIA",), "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    Rule("hex", (_DIGIT * 24,), "[0-9a-f]+", lambda m: len(m[0]) >= 24),
    Rule("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "gh[pousr]_([0-9A-Za-z]+)", crc_in_base62),
    Rule("npm", ("npm_",), "npm_([0-9A-Za-z]+)", crc_in_base62),
)
BASE = ("assign", "access", "hex")


class Scanner:
    def __init__(self, rules: Sequence[Rule] = RULES):
        self._rules = [(re.compile(r.pattern, re.ASCII), r.sound) for r in rules]
        automaton, owners = ahocorasick.Automaton(), {}
        for n, rule in enumerate(rules):
            for keyword in rule.keywords:
                owners.setdefault(fold(keyword), []).append(n)
        for keyword, found in owners.items():
            automaton.add_word(keyword, (len(keyword), tuple(found)))
        automaton.make_automaton()
        self._automaton = automaton

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, number of the rule, end) of every sound match, in order.

        Hits come by their ends; those of one rule come by their starts as
        well, since none of its keywords lies inside another.
        """
        found, after = [], [0] * len(self._rules)
        for last, (length, owners) in self._automaton.iter(fold(text)):
            start = last + 1 - length
            for n in owners:
                if start < after[n]:
                    continue
                pattern, sound = self._rules[n]
                match = pattern.match(text, start)
                if match:
                    after[n] = match.end()
                    if sound(match):
                        found.append((start, n, match.end()))
        return sorted(found)


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _masked(text: str, spans: list[tuple[int, int, int]], rules: Sequence[Rule]) -> str:
    parts, at = [], 0
    for start, n, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{rules[n].kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _scanner(rules: Sequence[Rule], masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kinds = np.array([r.kind for r in rules], object)
        for part, _, _ in chunks(batches, TEXT):
            counts, rows, texts = [0], [], []
            for text in part.column(TEXT).to_pylist():
                found = scanner.spans(text)
                rows += found
                counts.append(len(rows))
                if masked:
                    texts.append(_masked(text, found, rules))
            start, n, end = np.array(rows, np.int64).reshape(-1, 3).T
            items = pa.StructArray.from_arrays(
                [pa.array(kinds[n], pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["kind", "start", "end"]
            )
            lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), items)
            others = [c for c in part.schema.names if c != TEXT]
            columns = [*[part.column(c) for c in others], lists, *([pa.array(texts, pa.string())] if masked else [])]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "spans", *(["masked"] if masked else [])])

    return run


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``_id, _fp, spans`` of every row: ``(kind, start, end)`` by start, then in the rules' order, in code points.

    Null and empty texts have no span. Every row is scanned by itself, whole, so
    repeated rows have equal results; an empty table gives an empty one, and
    other columns, whatever their names, are not looked at. Nothing is shuffled;
    a task holds a few hundred KiB of texts at a time, or one text and its folded
    copy if that is longer.
    """
    rows = keyed(docs, id_column, text_column)
    return rows.mapInArrow(_scanner(rules, False), f"{ID} long, {FP} long, spans {_SPANS}")


def masked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with ``[kind]`` in place of each secret; of spans that overlap the first names the kind. Null texts become empty."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_column]).alias("_row")
    rows = keyed(docs, id_column, text_column, whole)
    layout = T.StructType([f for f in rows.schema if f.name != TEXT]).add("spans", T.StructType.fromDDL(f"x {_SPANS}")["x"].dataType).add("masked", "string")
    done = rows.mapInArrow(_scanner(rules, True), layout)
    return done.select(*[F.col("masked" if c == text_column else f"_row.`{c}`").alias(c) for c in docs.columns])


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def summary(docs: DataFrame) -> DataFrame:
    counts = [F.size(_of_kinds(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return find_secrets(docs).select(
        public_id("doc_id"), *counts, F.sha2(_written(_of_kinds(*BASE)), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans")
    )


#: Kind, place in the order, pattern, and what a match ``m`` must be. The tokens' check is
#: a CRC-32 taken bit by bit, held against six digits of base 62.
_CRC = """
  length(m) = 40 AND
  list_reduce([strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', d) - 1
               for d in string_split(right(m, 6), '')], lambda a, d: a * 62 + d) =
  xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, [CASE WHEN k % 8 = 0 THEN ord(substr(m, 5 + k // 8, 1))::BIGINT ELSE 0::BIGINT END for k in range(240)]),
    lambda a, v: CASE WHEN xor(a, v) % 2 = 1 THEN xor(xor(a, v) // 2, 3988292384::BIGINT) ELSE xor(a, v) // 2 END))
"""
_SQL_RULES = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
     r"length(regexp_extract(m, '[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]{24,}", "true"),
    ("github", "gh[pousr]_[0-9A-Za-z]+", _CRC),
    ("npm", "npm_[0-9A-Za-z]+", _CRC),
]
ORACLE = (
    "WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"
    + "".join(
        f""", p_{kind} AS (
  SELECT r, generate_subscripts(gaps, 1) AS i, unnest(gaps) AS gap, unnest(list_append(found, NULL)) AS m
  FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found FROM docs WHERE regexp_matches(t, '{pattern}'))
), s_{kind} AS (
  SELECT r, {n} AS k, '{kind}' AS kind, m,
         sum(length(gap) + coalesce(length(m), 0)) OVER (PARTITION BY r ORDER BY i) - coalesce(length(m), 0) AS s
  FROM p_{kind}
)"""
        for n, (kind, pattern, _) in enumerate(_SQL_RULES)
    )
    + ", spans AS (" + " UNION ALL ".join(
        f"SELECT r, k, kind, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e FROM s_{kind} WHERE m IS NOT NULL AND {sound}"
        for kind, _, sound in _SQL_RULES
    )
    + """), written AS (
  SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN written USING (r)
"""
)
