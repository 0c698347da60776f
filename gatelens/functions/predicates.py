"""Filters: root term, time range, user query and their conjunction."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.functions.time import TimeRange, day_span, in_time_range, restrict_days
from gatelens.schemas import column_name

# Pieces of a query string: a clause (field, then a quoted text, a range or a word), an operator or a parenthesis.
PIECE = re.compile(
    r"""(?P<field>[@\w][\w.-]*):(?:"(?P<quoted>(?:[^"\\]|\\.)*)"|(?P<range>[\[{][^\]}]*[\]}])|(?P<word>[^\s()":][^\s()"]*))"""
    r"""|(?P<operator>AND|OR|NOT|&&|\|\|)(?=[\s(]|$)|(?P<parenthesis>[()])|\s+"""
)
RANGE = re.compile(r'([\[{])\s*("[^"]*"|\S+)\s+TO\s+("[^"]*"|\S+)\s*([\]}])')
COMPARISON = re.compile(r"(>=|<=|>|<)(.+)")
OPERATORS = {"&&": "AND", "||": "OR"}


def equals(field: str, value) -> Column:
    """Exact term on a field."""
    return F.col(column_name(field)) == F.lit(value)


def field_between(field: str, gte=None, lte=None) -> Column:
    """Range on any field, both ends included, either may be open."""
    column = F.col(column_name(field))
    tests = [column >= F.lit(gte)] if gte is not None else []
    tests += [column <= F.lit(lte)] if lte is not None else []
    return all_of(tests)


def matches(query: str | Column) -> Column:
    """User filter: a query string, a Spark SQL boolean, or a Column.

    A query string consists of clauses joined by ``AND``, ``OR``, ``NOT`` and parentheses; clauses that only follow one
    another are joined by ``OR``. A clause is ``field:value``, ``field:"quoted value"``, ``field:wild*car?``,
    ``field:[a TO b]`` (``{`` and ``}`` exclude the end, ``*`` leaves it open), ``field:>=a`` or ``_exists_:field``.
    Clauses become SQL conditions; Spark parses how they are joined. A text with clauses and anything else is refused.
    """
    if isinstance(query, Column):
        return query
    pieces = query_pieces(query)
    return F.expr(query if pieces is None else joined_clauses(pieces))


def query_pieces(query: str) -> list[re.Match] | None:
    """The pieces of a query string; None for a text without clauses, which is SQL."""
    pieces, at, rest = [], 0, ""
    while at < len(query):
        piece = PIECE.match(query, at)
        if piece is None:
            rest = rest or query[at:]
            at += 1
            continue
        pieces.append(piece)
        at = piece.end()
    pieces = [p for p in pieces if p[0].strip()]
    clauses = [p for p in pieces if p["field"]]
    if not clauses or (rest and re.search(r"[<>=']|::", PIECE.sub(" ", query))):
        return None
    if rest:
        raise ValueError(f"not understood in query {query!r}: {rest!r}")
    return pieces


def joined_clauses(pieces: list[re.Match]) -> str:
    negated = any(p["operator"] == "NOT" for p in pieces)
    words, open_end = [], False  # open_end: an operand has just ended
    for piece in pieces:
        starts = piece["field"] or piece[0] == "(" or piece["operator"] == "NOT"
        if starts and open_end:
            words.append("OR")
        open_end = bool(piece["field"]) or piece[0] == ")"
        if piece["field"]:
            condition = clause_condition(piece)
            # A document without the field is one that doesn't match, also under NOT.
            words.append(f"coalesce({condition}, false)" if negated else f"({condition})")
        else:
            words.append(OPERATORS.get(piece[0], piece[0]))
    return " ".join(words)


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def clause_condition(piece: re.Match) -> str:
    """One clause as SQL."""
    if piece["field"] == "_exists_":
        return f"`{column_name(piece['quoted'] or piece['word'])}` IS NOT NULL"
    column = f"`{column_name(piece['field'])}`"
    if piece["quoted"] is not None:
        return f"{column} = {sql_text(re.sub(r'\\(.)', r'\1', piece['quoted']))}"
    if piece["range"]:
        ends = RANGE.fullmatch(piece["range"])
        if ends is None:
            raise ValueError(f"not a range: {piece[0]!r}")
        low, high = (e[1:-1] if e.startswith('"') else e for e in (ends[2], ends[3]))
        tests = [f"{column} IS NOT NULL"]
        if low != "*":
            tests.append(f"{column} {'>=' if ends[1] == '[' else '>'} {sql_text(low)}")
        if high != "*":
            tests.append(f"{column} {'<=' if ends[4] == ']' else '<'} {sql_text(high)}")
        return " AND ".join(tests)
    word = piece["word"]
    if comparison := COMPARISON.fullmatch(word):
        return f"{column} {comparison[1]} {sql_text(comparison[2])}"
    if word == "*":
        return f"{column} IS NOT NULL"
    if re.search(r"(?<!\\)[*?]", word):
        signs = {"*": "%", "?": "_", "%": "\\%", "_": "\\_"}
        pattern = re.sub(r"\\(.)|([*?%_])", lambda m: m[1] if m[1] and m[1] not in "%_" else signs.get(m[2] or m[1], m[0]), word)
        return f"CAST({column} AS STRING) LIKE {sql_text(pattern)}"
    if re.search(r"[~^]\d*$", word):
        raise ValueError(f"fuzzy and boosted clauses are not supported: {piece[0]!r}")
    return f"{column} = {sql_text(re.sub(r'\\(.)', r'\1', word))}"


def all_of(tests: Iterable[Column]) -> Column:
    """Conjunction; of nothing it is true."""
    return reduce(lambda a, b: a & b, list(tests) or [F.lit(True)])


def has_id(ids: Iterable[str]) -> Column:
    return F.col("id").isin([str(i) for i in ids])


def select_documents(
    docs: DataFrame,
    time_range: TimeRange | None = None,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Documents that pass whichever of the three filters are given.

    Catalyst cannot derive the day from the time range, so a day-partitioned
    table gets both predicates: one prunes directories, one prunes row groups.
    """
    if time_range is not None:
        if "day" in docs.columns:
            docs = restrict_days(docs, *day_span(time_range, zone), zone)
        docs = docs.where(in_time_range(time_range))
    if root is not None:
        docs = docs.where(equals(*root))
    if query is not None:
        docs = docs.where(matches(query))
    return docs
