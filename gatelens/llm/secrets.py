"""Secrets in texts, with parts of credentials linked across a text; DataFrame functions only.

Three kinds are findings by themselves (assignments, access identifiers, long hex strings). Weak parts are reported
only in company: an access identifier, a token-like string and an endpoint within ``scope`` characters of a part of
another kind. Parts are exploded, put into bins as wide as the scope, and joined on document and bin; only the parts,
never the texts, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatelens.llm.common import saved

# The patterns of the findings.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
# Own values: weak parts of a credential. A key is 32 or more letters and digits that mix cases and digits; an account
# is a named login; an endpoint is the address of a service.
KEY = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ACCOUNT = r"""(?i:user_?name|user_?id|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
ENDPOINT = r"(?:https?|ftp|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:@/?&=%+-]+"
#: Kinds in the order of results: (kind, pattern, role in a credential, whether it counts alone).
KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "identifier", True),
    ("hex", HEX, "secret", True),
    ("key", KEY, "secret", False),
    ("account", ACCOUNT, "identifier", False),
    ("endpoint", ENDPOINT, "endpoint", False),
)
_PART = "array<struct<kind:int,place:int,gap:int,size:int,ok:boolean>>"


def _parts(text: Column, number: int) -> Column:
    """All matches of a kind, leftmost first, without overlap: the characters since the match before, and its own.

    The pieces between matches and the matches make up the text, so their lengths add up to positions.
    """
    kind, pattern, _, _ = KINDS[number]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind == "assign":
        ok = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.char_length(v) >= ASSIGN_VALUE)
    elif kind == "key":
        ok = F.transform(found, lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]"))
    else:
        ok = F.transform(found, lambda v: F.lit(True))
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("m"), ok.alias("ok"))
    parts = F.transform(
        zipped,
        lambda z, i: F.struct(F.lit(number).alias("kind"), i.alias("place"), F.char_length(z["gap"]).alias("gap"), F.char_length(z["m"]).alias("size"), z["ok"].alias("ok")),
    )
    return F.when(text.rlike(pattern), parts.cast(_PART)).otherwise(F.array().cast(_PART))


def find_secrets(docs: DataFrame, scope: int = 200, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of secrets per document: (id_column, findings), one row per row of ``docs``.

    ``findings`` is an array of (start, kind, end, name, alone) in code points, end exclusive, ordered by start and
    kind; ``alone`` is false for weak parts, which are there only if a secret and an identifier or endpoint (one of them
    the part itself) are at most ``scope`` characters apart. Parts that overlap don't complete each other: one string is
    not two parts of a credential.

    Defined cases: null and empty texts have no findings; a null id stays null; repeated rows have their findings each;
    of matches of one kind the leftmost holds, those of different kinds may overlap. An empty table gives an empty
    result. Other columns, whatever their names, play no part.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    parts = F.concat(*(_parts(text, k) for k in range(len(KINDS))))
    # Written once: the texts are searched once, and row numbers are fixed from here on.
    rows = saved(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), parts.alias("_parts")))

    upto = Window.partitionBy("_row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = (
        rows.select("_row", F.inline("_parts"))
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
        .where("ok")
        .select("_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end")
    )
    of_kind = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), F.col("kind") + 1)
    spans = spans.select("*", of_kind([k[2] == "secret" for k in KINDS]).alias("secret"), of_kind([k[3] for k in KINDS]).alias("alone"))
    weak = spans.where("not alone").withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope))))
    others = spans.select(
        F.col("_row").alias("o_row"), F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.col("secret").alias("o_secret"),
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("o_bin"),
    )
    linked = weak.join(
        others,
        (F.col("_row") == F.col("o_row")) & (F.col("bin") == F.col("o_bin")) & (F.col("secret") != F.col("o_secret"))
        & (F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope)
        & ((F.col("o_end") <= F.col("start")) | (F.col("o_start") >= F.col("end"))),
        "left_semi",
    ).drop("bin").distinct()
    names = F.element_at(F.array(*(F.lit(k[0]) for k in KINDS)), F.col("kind") + 1)
    found = (
        spans.where("alone").unionByName(linked).groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", names.alias("name"), "alone"))).alias("findings"))
    )
    empty = F.array().cast(found.schema["findings"].dataType)
    return rows.select("_row", "_id").join(found, "_row", "left").select(F.col("_id").alias(id_column), F.coalesce("findings", empty).alias("findings"))
