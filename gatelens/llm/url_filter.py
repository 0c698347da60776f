"""URL rules by a sort-merge range join.

Every url gets a canonical key: its host's labels reversed, each ended by a dot, then its path. A rule for a host and
all its subdomains is then an interval of keys, and two rules' intervals are nested or apart. Urls and rules are dealt
to ranges of keys and sorted together; one sweep over a range keeps the rules whose intervals are open on a stack, and
asks the stack's rules for the longest fitting one at each url.

Ranges come from a bounded sample of keys. A key that fills several ranges (many rows of one url) is dealt over them by
a hash of the row, so no task gets it whole. A rule goes to every range that its interval meets: those it starts in,
and the few open ones at the start of each other range. Nothing else is repeated, and nothing is collected but the sample.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import lower_ascii, ship

#: Keys sampled per range to find the ranges' edges, and the characters of a key that an edge keeps.
SAMPLE_PER_RANGE = 32
EDGE_LENGTH = 200


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a dot: ``a.example.org`` becomes ``org.example.a.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Open:
    """The rules of one host while the sweep is inside their interval."""

    __slots__ = ("end", "host", "lengths", "paths")

    def __init__(self, host: str, key: str):
        # The key ends with a dot; the next character after it ends the interval.
        self.host, self.end = host, key[:-1] + "/"
        self.paths: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        rule = (self.host + path, verdict)
        # Of two equal rules the smaller verdict (allow before block) holds.
        self.paths[path] = min(rule, self.paths.get(path, rule))
        if len(path) not in self.lengths:
            bisect.insort(self.lengths, len(path))

    def longest(self, path: str) -> tuple[str, str] | None:
        for n in reversed(self.lengths):
            if n <= len(path) and (found := self.paths.get(path[:n])):
                return found
        return None


def _sweep(batches: Iterator[pa.RecordBatch], default: str) -> Iterator[pa.RecordBatch]:
    stack: list[_Open] = []
    current = None
    for batch in batches:
        names = batch.schema.names
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(names)}
        keep, rules, verdicts = [], [], []
        for i, (part, key, is_url, path) in enumerate(zip(columns["part"], columns["key"], columns["is_url"], columns["path"], strict=True)):
            if part != current:
                current, stack = part, []
            while stack and key >= stack[-1].end:
                stack.pop()
            if not is_url:
                if not stack or stack[-1].host != columns["host"][i]:
                    stack.append(_Open(columns["host"][i], key))
                stack[-1].add(path, columns["verdict"][i])
                continue
            best = None
            for rules_of_host in reversed(stack):
                found = rules_of_host.longest(path)
                if found and (best is None or len(found[0]) > len(best[0])):
                    best = found
            keep.append(i)
            rules.append(best[0] if best else None)
            verdicts.append(best[1] if best else default)
        if keep:
            taken = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("id"), taken.column("host"), taken.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["id", "host", "path", "rule", "verdict"],
            )


def _edges(keys: DataFrame, ranges: int) -> list[str]:
    """Edges that split the keys into even ranges, from a sample whose size follows the number of ranges only."""
    want = SAMPLE_PER_RANGE * ranges
    rows = keys.count()
    if not rows:
        return []
    sample = keys.sample(min(1.0, want / rows), seed=11) if rows > want else keys
    found = sorted(r[0] for r in sample.select(F.substring("key", 1, EDGE_LENGTH)).limit(4 * want).collect())
    return [found[len(found) * k // ranges] for k in range(1, ranges)] if found else []


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """The longest rule that fits each page's url: columns (id_column, host, path, rule, verdict).

    ``rules`` has (host, path, verdict). A rule fits its host and every subdomain if the url's path starts with the
    rule's; the longest (host and path together) wins, of equally long ones that of the longer host. Urls that no rule
    fits have a null rule and the verdict ``default``.

    Defined cases: a null url, or one without ``://``, has an empty host and path and no rule. Null ids stay null.
    Repeated rows are judged each; repeated rules count once, and of contradicting equal rules the smaller verdict
    holds. Rules without host, path or verdict are ignored. Empty pages give an empty result, empty rules the default
    everywhere. Other columns of either table, whatever their names, play no part.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path = url_parts(F.col(url_column))
    urls = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path")).withColumn("key", F.concat(host_key(F.col("host")), "path"))
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = _edges(urls.select("key"), ranges)

    def range_of(key: pa.Array, salt: pa.Array) -> pa.Array:
        """The range of each key; one that equals several edges goes to one of their ranges, by its salt."""
        out = []
        for k, s in zip(key.to_pylist(), salt.to_pylist(), strict=True):
            k = k[:EDGE_LENGTH]
            low, high = bisect.bisect_left(edges, k), bisect.bisect_right(edges, k)
            out.append(low + s % (high - low + 1) if high > low else low)
        return pa.array(out, pa.int32())

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([range_of(b.column("key"), b.column("salt")), *(b.column(n) for n in ("key", "id", "host", "path"))], names=["part", "key", "id", "host", "path"])

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict[str, list] = {n: [] for n in ("part", "key", "host", "path", "verdict")}
            for r in b.to_pylist():
                low = bisect.bisect_left(edges, r["key"][:EDGE_LENGTH])
                high = bisect.bisect_right(edges, (r["key"][:-1] + "/")[:EDGE_LENGTH])
                for part in range(low, high + 1):
                    for n, v in (("part", part), *r.items()):
                        rows[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows["part"], pa.int32()), *(pa.array(rows[n], pa.string()) for n in ("key", "host", "path", "verdict"))], names=list(rows))

    id_type = dict(pages.dtypes)[id_column]
    dealt = urls.withColumn("salt", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(1 << 30)))
    placed = dealt.mapInArrow(place_urls, f"part int, key string, id {id_type}, host string, path string")
    known = (
        rules.select(lower_ascii(F.col("host")).alias("host"), F.col("path").alias("path"), F.col("verdict").alias("verdict"))
        .where("host is not null and path is not null and verdict is not null")
        .withColumn("key", host_key(F.col("host")))
        .select("key", "host", "path", "verdict")
        .mapInArrow(place_rules, "part int, key string, host string, path string, verdict string")
    )
    events = placed.select("part", "key", F.lit(True).alias("is_url"), "id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        known.select("part", "key", F.lit(False).alias("is_url"), F.lit(None).cast(id_type).alias("id"), "host", "path", "verdict")
    )
    swept = (
        events.repartition(ranges, "part")
        .sortWithinPartitions("part", "key", "is_url", "path")
        .mapInArrow(lambda b: _sweep(b, default), f"id {id_type}, host string, path string, rule string, verdict string")
    )
    return swept.select(F.col("id").alias(id_column), "host", "path", "rule", "verdict")
