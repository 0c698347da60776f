"""Removal of lines that many documents share, with DataFrame functions only.

Lines are exploded, normalised and hashed; one aggregation over the hashes, written once, finds those in enough documents
and the document that keeps each; a join brings the positions to drop back to the documents, whose lines are put together
again in order. For that join a line that makes up more than a thousandth of all lines is dealt over several tasks. Texts
move once, in the last join, and only if positions to drop can't be broadcast. The hash is 128 bits wide, so that
different lines of 10^13 are not taken for one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import SPACES, lower_ascii, saved

_NO_ID = (1 << 63) - 1
#: No task of the join gets more lines of one key than all lines divided by this; so many keys at most have more.
SHARES = 1000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def dedup_lines(
    docs: DataFrame, min_docs: int = 2, min_length: int = 10, id_column: str = "doc_id", text_column: str = "text", counts: bool = True
) -> DataFrame:
    """``docs`` with repeated lines removed from the text, and with ``counts`` (n_lines, n_dropped) of each row behind its columns.

    Lines end at ``\\n``. Keys (:func:`line_key`) of at least ``min_length`` code points found in at least ``min_docs``
    documents lose all their lines but those of the smallest id that holds them; other lines stay, joined by ``\\n``.

    Defined cases: a null or empty text is one empty line, and its result is an empty text. Rows are documents by their
    id: rows that share an id count as one document, each row is rebuilt by itself. A null id counts as one document
    behind all others. Ids are integers, or texts of integers. An empty table gives an empty result. Other columns stay as they are; those named n_lines or
    n_dropped give way to the counts.
    """
    own = [c for c in docs.columns if not counts or c not in ("n_lines", "n_dropped")]
    ident = F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID))
    text = F.coalesce(F.col(text_column), F.lit(""))
    row = [ident.alias("_doc"), F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(7), text).alias("_t2")]

    lines = (
        docs.select(*row, F.posexplode(_lines(F.col(text_column))).alias("_pos", "_line"))
        .withColumn("_key", line_key(F.col("_line")))
        .where(F.char_length("_key") >= min_length)
        .select("_doc", "_t1", "_t2", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(7), "_key").alias("_h2"))
    )
    key = ["_h1", "_h2"]
    if min_docs == 2:  # two documents differ if the smallest id is not the largest: no distinct count is needed
        several = (F.min("_doc") < F.max("_doc")).alias("_several")
    else:
        several = (F.count_distinct("_doc") >= min_docs).alias("_several")
    counted = saved(lines.groupBy(*key).agg(F.min("_doc").alias("_keeper"), several, F.count("*").alias("_n")))
    # In how many tasks the lines of a key meet their keeper: one, but for the few keys with many lines.
    total = counted.agg(F.sum("_n")).scalar()
    shared = counted.where("_several").select(*key, "_keeper", F.ceil(F.col("_n") * SHARES / total).cast("int").alias("_tasks"))
    frequent = shared.where("_tasks > 1").select(*key, F.col("_tasks").alias("_over"))
    dealt = lines.join(F.broadcast(frequent), key, "left").withColumn("_task", F.pmod(F.xxhash64("_doc", "_pos"), F.coalesce("_over", F.lit(1))).cast("int"))
    keepers = shared.select(*key, "_keeper", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)).alias("_task"))
    drops = (
        dealt.join(keepers, [*key, "_task"])
        .where("_doc <> _keeper")
        .groupBy("_doc", "_t1", "_t2")
        .agg(F.sort_array(F.collect_set("_pos")).alias("_drops"))
    )

    # The row travels as one struct, so that its columns may have any names.
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), *row)
    out = out.join(drops, ["_doc", "_t1", "_t2"], "left")
    text = F.coalesce(F.col("_row").getField(text_column), F.lit(""))
    out = out.withColumn("_lines", _lines(text)).withColumn("_drops", F.coalesce("_drops", F.array().cast("array<int>")))
    # The runs of lines between dropped positions, so that a text of many lines costs one pass.
    edges = F.concat(F.array(F.lit(-1)), F.col("_drops"), F.array(F.size("_lines")))
    out = out.withColumn("_edges", edges)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_edges") - 1),
        lambda i: F.slice("_lines", F.element_at("_edges", i) + 2, F.element_at("_edges", i + 1) - F.element_at("_edges", i) - 1),
    )
    kept = F.when(F.size("_drops") == 0, text).otherwise(F.array_join(F.flatten(runs), "\n"))
    numbers = [F.size("_lines").cast("long").alias("n_lines"), F.size("_drops").cast("long").alias("n_dropped")]
    columns = [kept.alias(c) if c == text_column else F.col("_row").getField(c).alias(c) for c in own]
    return out.select(*columns, *(numbers if counts else []))
