"""The automaton's scores of whole texts against a model of dictionaries that goes back word by word."""

import math
import re
import zlib
from collections import Counter

import pytest

from gatelens.llm import lm_score

SF = "/root/testdata/sf0.001"


def expected_scores(texts):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold)), None] for i, t in texts.items()}
    counts = [Counter(), Counter(), Counter()]
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            for n in range(3):
                counts[n].update(tuple(t[k : k + n + 1]) for k in range(len(t) - n))
    followers = Counter(g[:-1] for n in (1, 2) for g in counts[n])
    total, distinct = sum(counts[0].values()), len(counts[0])

    def p(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 0.1) / (total + 0.1 * (distinct + 1))
        seen = counts[len(gram) - 2][gram[:-1]]
        if not seen:
            return p(gram[1:])
        return max(counts[len(gram) - 1][gram] - 0.75, 0) / seen + 0.75 * followers[gram[:-1]] / seen * p(gram[1:])

    return {i: math.fsum(math.log10(p(tuple(t[max(0, k - 2) : k + 1]))) for k in range(len(t))) for i, t in tokens.items()}


@pytest.fixture(scope="module")
def table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    # A pair that makes up a third of all words.
    return docs.unionByName(spark.createDataFrame([(10_000_000 + i, f"hot pair w{i} hot pair " * 700) for i in range(40)], "doc_id long, text string"))


@pytest.mark.parametrize("sizes", [{}, {"PART_TOKENS": 20_000, "WORD_TOKENS": 9_000, "PIECE": 37, "BLOCK_BYTES": 50_000}, {"PART_TOKENS": 100, "PIECE": 1}])
def test_scores_equal_a_model_of_dictionaries(spark, table, monkeypatch, sizes):
    """With any number of parts, blocks and pieces, with frequent histories spread over the parts or not."""
    for name, value in sizes.items():
        monkeypatch.setattr(lm_score, name, value)
    if "PART_TOKENS" in sizes and sizes["PART_TOKENS"] == 100:
        table = table.where("doc_id % 10 = 0")
    expected = expected_scores({r["doc_id"]: r["text"] for r in table.collect()})
    got = {r["doc_id"]: r["score"] for r in lm_score.score(table).collect()}
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[i], expected[i], rel_tol=1e-9) for i in got)


def test_what_follows_a_frequent_pair_is_dealt_over_the_parts():
    """N-grams after the pair reach many parts, those after rare histories one part each."""
    import numpy as np

    block = lm_score._Block.__new__(lm_score._Block)
    block.numbers, block.totals = np.arange(1002), np.concatenate([[5000, 5000], np.full(1000, 5)])
    ends = np.arange(2, 1002, dtype=np.int32)
    pairs = lm_score._Grams(np.array([1]), np.zeros(1, np.int32), np.ones(1, np.int32), np.array([5000], np.int32))
    after = lm_score._Grams(ends.astype(np.int64), np.zeros(1000, np.int32), ends, np.full(1000, 5, np.int32))
    largest = lambda often: max(len(lm_score._Deal(block, [pairs, after], 20, often).of_part(i)[2]) for i in range(1))
    spread = lm_score._Deal(block, [pairs, after], 20, 1000)
    assert len(spread.present) == 20 and max(len(spread.of_part(i)[2]) for i in range(20)) < 100
    assert largest(10_000) == 1000
