"""SimHash groups, ranked search and tokenizer alignment: brute force on whole tables, edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gatelens.llm import lexical_search, simhash_dedup
from gatelens.llm.lexical_search import ranked_search
from gatelens.llm.queries import QUERIES, TOKENIZERS
from gatelens.llm.simhash_dedup import linked_fingerprints, segments, simhash_duplicates, variants
from gatelens.llm.token_alignment import ByteTokens, align_tokenizers, overlaps, shared_cuts

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
A_PATH, B_PATH = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
LONG = " ".join(f"w{i % 5000} and" for i in range(60_000))
CLASHES = "id print key low high n own root least component item part place rank score block row pair total best totals of_block terms counts".split()


def clashing(spark, rows, schema):
    out = spark.createDataFrame(rows, schema)
    return out.select("*", *(F.lit("x").alias(c) for c in CLASHES if c not in out.columns))


def table_rows(sf, name="documents", columns="doc_id, text"):
    return duckdb.sql(f"SELECT {columns} FROM '/root/testdata/{sf}/{name}.parquet'").fetchall()


# SimHash --------------------------------------------------------------------------------------------------------


def fingerprint(text, size=4):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", (text or "").translate(FOLD)) if w]
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    """The place of the first member of each print's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_op11_against_all_pairs(spark):
    docs = sorted(table_rows("sf0.01"))
    prints = [fingerprint(t) for _, t in docs]
    want = {(d, f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, groups(prints, 4), strict=True)}
    got = QUERIES["op11_simhash_dedup"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == want
    assert any(d != c for d, _, c in want)


def test_one_segment_differs_in_one_bit_at_most(spark):
    """Every pattern of up to four differing bits meets in a variant, and no key is shared across segments or wildcards."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    flips = [sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 1, 2, 3, 4) for _ in range(60)]
    flips += [(1 << 20) | (1 << 21) | (1 << 42) | (1 << 43), (1 << 63) | 7]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    rows = spark.createDataFrame([(i, signed(base ^ f)) for i, f in enumerate(flips)], "i int, print long").select("i", variants("print", 4).alias("keys")).collect()
    keys = {r["i"]: r["keys"] for r in rows}
    assert len(segments(4)) == 3 and all(len(set(k)) == 64 for k in keys.values())
    assert all(set(keys[0]) & set(k) for k in keys.values())
    assert [len(segments(d)) for d in (0, 1, 2, 3, 4, 5, 6)] == [1, 1, 2, 2, 3, 3, 4]


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_crowded_variants_are_cut_into_blocks(spark, monkeypatch, distance):
    """A ball of near fingerprints, far more than one block holds: the same components, few links."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", 16)
    rng = random.Random(distance)
    prints = set()
    for center in (rng.getrandbits(64), rng.getrandbits(64), 0):
        prints |= {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))) for _ in range(120)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints], "print long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in linked_fingerprints(frame, distance).collect()]
    place = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(prints))] == groups(prints, distance)
    assert len(links) < sum(1 for i, a in enumerate(prints) for b in prints[i + 1 :])


def test_op11_edges(spark):
    text = "The quick brown fox jumps over the lazy dog"
    rows = [
        (5, text), (3, text.upper()), (3, text), (4, text.replace(" ", " \n\t")), (None, text), (9, None), (8, ""), (7, " \n "), (6, "one two"), (2, "ONE  two"), (1, LONG),
        (11, "É a b\x00c d e"), (None, "nothing else is like this line of words"), (12, "x"),
    ]
    got = [tuple(r) for r in simhash_duplicates(clashing(spark, rows, "doc_id long, text string")).collect()]
    prints = [fingerprint(t) for _, t in rows]
    roots = groups(prints, 4)
    least = [min((rows[j][0] for j in range(len(rows)) if roots[j] == r and rows[j][0] is not None), default=None) for r in roots]
    assert Counter(got) == Counter((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, least, strict=True))
    assert {g[2] for g in got if g[0] in (7, 8, 9)} == {7} and (None, f"{prints[12]:016x}", None) in got
    assert simhash_duplicates(clashing(spark, [], "doc_id long, text string")).collect() == []
    renamed = spark.createDataFrame([(1, "a b"), (2, "a b")], "print int, key string")
    assert {tuple(r)[2] for r in simhash_duplicates(renamed, id_column="print", text_column="key").collect()} == {1}


# Ranked search ----------------------------------------------------------------------------------------------------


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def ranking(docs, items, k=10):
    counts = [Counter(terms_of(t)) for _, t in docs]
    lengths = [sum(c.values()) for c in counts]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    holding = Counter(t for c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c, n in zip(docs, counts, lengths, strict=True):
            m = 10 + (90 * n * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def test_op12_small_tiles(spark, monkeypatch):
    """Many tiles of documents and terms, blocks of items: the same ranking as by brute force."""
    for name, value in (("DOCUMENTS", 7), ("TERMS", 5), ("ITEMS", 3), ("VOCABULARY", 60), ("PARTS", 2)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = table_rows("sf0.001")[:150], table_rows("sf0.001", "benchmark", "item_id, text")[:8]
    docs += [(1000 + i, docs[3][1]) for i in range(15)]  # ties beyond the last place
    items.append((77, docs[3][1][:300]))
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    got = ranked_search(frames[0].repartition(5), frames[1])
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in got.collect()) == ranking(docs, items)


def test_op12_edges(spark):
    docs = [(1, "Alpha beta-BETA gamma"), (1, "Alpha beta-BETA gamma"), (2, None), (3, ""), (4, "... !"), (None, "alpha"), (None, "delta 7"), (5, "É\x00é alpha7  x"), (6, LONG), (7, "ALPHA")]
    items = [(1, "alpha beta, beta"), (1, "alpha beta, beta"), (2, None), (3, ""), (4, "?"), (None, "Delta"), (5, "é  É"), (6, "w17 and and"), (7, "nowhere")]
    frames = [clashing(spark, rows, schema) for rows, schema in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    assert Counter(tuple(r) for r in ranked_search(*frames, k=3).collect()) == ranking(docs, items, k=3)
    assert ranked_search(frames[0].where("false"), frames[1]).collect() == []
    assert ranked_search(frames[0], frames[1].where("false")).collect() == []
    assert ranked_search(frames[0].where("doc_id = 4"), frames[1]).collect() == []
    everywhere = spark.createDataFrame([(i, "same") for i in range(30)], "doc_id long, text string")
    item = spark.createDataFrame([(1, "same")], "item_id long, text string")
    assert Counter(tuple(r) for r in ranked_search(everywhere, item).collect()) == ranking([(i, "same") for i in range(30)], [(1, "same")])


# Tokenizer alignment ------------------------------------------------------------------------------------------------


def alignment(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    first.encode_special_tokens = True
    table = ByteTokens(A_PATH).bytes
    facts, links, counts = [], [], Counter()
    for _, text in docs:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        pieces = [bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
        parts = [table[x] for x in a]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(parts) != whole or b"".join(pieces) != whole:
            facts.append((0, 0, 0, "")), links.append([])
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in parts]).tolist(), np.cumsum([len(x) for x in pieces]).tolist()
        written, low_a, low_b, own = [], 0, 0, []
        for cut in sorted(set(a_ends) & set(b_ends)):
            high_a, high_b = a_ends.index(cut, low_a) + 1, b_ends.index(cut, low_b) + 1
            written.append(",".join(map(str, a[low_a:high_a])) + "|" + ",".join(map(str, b[low_b:high_b])))
            for i in range(low_a, high_a):
                for j in range(low_b, high_b):
                    if max(a_ends[i] - len(parts[i]), b_ends[j] - len(pieces[j])) < min(a_ends[i], b_ends[j]):
                        own.append((a[i], b[j]))
            low_a, low_b = high_a, high_b
        facts.append((len(a), len(b), len(written), hashlib.sha256(";".join(written).encode()).hexdigest()))
        links.append(own), counts.update(own)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return Counter(
        (d, *f[:3], len(own), sum(counts[x] == top[x[1]] for x in own), sum(counts[x] for x in own), f[3]) for (d, _), f, own in zip(docs, facts, links, strict=True)
    )


def test_op13_against_brute_force(spark):
    got = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == alignment(table_rows("sf0.001"))


def test_cuts_and_links_of_random_ends():
    rng = np.random.default_rng(3)
    for trial in range(300):
        a_ends, b_ends, a_edges, b_edges, base = [], [], [0], [0], 0
        for _ in range(rng.integers(1, 5)):
            n = int(rng.integers(0, 300 if trial % 10 == 0 else 40))
            if n:
                for ends in (a_ends, b_ends):
                    ends += [base + int(x) for x in sorted({*rng.integers(1, n + 1, rng.integers(1, n + 1)).tolist(), n})]
                base += n
            a_edges.append(len(a_ends)), b_edges.append(len(b_ends))
        a, b = np.array(a_ends, np.int64), np.array(b_ends, np.int64)
        a_cuts, b_cuts = shared_cuts(a, b, np.array(a_edges), np.array(b_edges))
        assert a[a_cuts].tolist() == b[b_cuts].tolist() == sorted(set(a_ends) & set(b_ends))
        left, right = overlaps(a, b, a_cuts, b_cuts)
        a_starts, b_starts = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(a_starts[i], b_starts[j]) < min(a[i], b[j])}
        assert len(left) == len(want) and set(zip(left.tolist(), right.tolist(), strict=True)) == want


def test_long_interval_without_a_cut():
    """Two documents, one with no shared end but its last: one group, found in a few rings."""
    n = 100_000
    a, b = np.arange(2, 2 * n + 1, 2), np.append(np.arange(1, 2 * n, 2), 2 * n)
    a, b = np.append(a, 2 * n + 5), np.append(b, [2 * n + 1, 2 * n + 5])
    a_cuts, b_cuts = shared_cuts(a, b, np.array([0, n, n + 1]), np.array([0, n + 1, n + 3]))
    assert a[a_cuts].tolist() == b[b_cuts].tolist() == [2 * n, 2 * n + 5]
    left, right = overlaps(a, b, a_cuts, b_cuts)
    assert len(left) == len(a) + len(b) - 2


def test_same_ids_as_the_tokenizer_itself():
    tokens = ByteTokens(A_PATH)
    assert tokens.fast is not None
    rng = random.Random(7)
    letters = "aebtz AEZ  \n\t\r 　 '0179.,;éßŁ日本\U0001f600\x00\x1c\x85​́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 80))) for _ in range(2000)]
    texts += [" " * 300_000, "a" * 5_000, "<|endoftext|> it's I'LL we've", *[t for _, t in table_rows("sf0.001")[:50]]]
    for text in texts:
        assert tokens.encode(text).tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids


def test_op13_edges(spark, monkeypatch):
    from gatelens.llm import token_alignment

    docs = [
        (1, "It's a test.\n\nWe'll see  twice   spaced"), (1, "It's a test.\n\nWe'll see  twice   spaced"), (2, None), (3, ""), (4, " "), (5, "\n"), (6, "a▁b"), (None, "null id"),
        (7, "<s> </s> <unk> <|endoftext|> <0x41>"), (8, "É\x00  日本語 \U0001f600"), (9, LONG), (10, "x" * 70_000), (11, "the " * 40_000), (12, " " * 2_000),
    ]
    want = alignment(docs)
    frame = clashing(spark, docs, "doc_id long, text string")
    assert Counter(tuple(r) for r in align_tokenizers(frame, A_PATH, B_PATH).collect()) == want
    assert any(r[0] == 6 and r[1:] == (0, 0, 0, 0, 0, 0, "") for r in want)
    for name, value in (("BLOCK_BYTES", 1_000), ("RUN_BYTES", 500), ("ROW_PAIRS", 3)):
        monkeypatch.setattr(token_alignment, name, value)
    few = [d for d in docs if d[0] not in (9,)]
    assert Counter(tuple(r) for r in align_tokenizers(spark.createDataFrame(few, "doc_id long, text string").coalesce(2), A_PATH, B_PATH).collect()) == alignment(few)
    assert align_tokenizers(frame.where("false"), A_PATH, B_PATH).collect() == []
