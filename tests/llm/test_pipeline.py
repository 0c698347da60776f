"""Each stage of the pipeline against brute force on its own input."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from gatelens.llm.common import saved
from gatelens.llm.lang_id import identify, train

DIR = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def inputs(spark):
    """The input of each stage, and the last one's result, over a table with hard rows among the given ones."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    hard = spark.createDataFrame(
        [(10_001, None, "en", "s", 0), (10_002, "", None, None, None), (None, "some words without an id but with letters", "en", "s", 5), (10_003, "12 34", "en", "s", 5), (10_003, "12 34", "en", "s", 5)],
        docs.schema,
    )
    frames = [docs.unionByName(hard)]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(saved(stage(spark, frames[-1], DIR)))
    return frames


def texts(frame):
    return {r["doc_id"]: r["text"] or "" for r in frame.collect()}


def test_names_and_columns(inputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "packing"]
    assert all(frame.columns == inputs[0].columns and [t for _, t in frame.dtypes] == [t for _, t in inputs[0].dtypes] for frame in inputs[1:5])


def test_language_id(inputs):
    judged = identify(inputs[0], train(inputs[0]))
    expected = Counter(r["doc_id"] for r in judged.collect() if r["lang_pred"] != "und" and r["score"] >= 0.4)
    assert Counter(r["doc_id"] for r in inputs[1].collect()) == expected
    assert None in expected and not {10_001, 10_002, 10_003} & set(expected) and len(expected) > 190


def test_line_dedup(inputs):
    before, after = texts(inputs[1]), texts(inputs[2])
    key = lambda line: line.strip(SPACE).translate(FOLD)
    holders = defaultdict(set)
    for i, t in before.items():
        for line in t.split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(float("inf") if i is None else i)
    mine = lambda i: float("inf") if i is None else i
    stays = lambda i, line: len(holders.get(key(line), ())) < 2 or min(holders[key(line)]) == mine(i)
    assert after == {i: "\n".join(x for x in t.split("\n") if stays(i, x)) for i, t in before.items()}
    assert after != before
    assert inputs[2].where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_near_dedup(inputs):
    before, after = texts(inputs[2]), texts(inputs[3])
    words = {i: [w for w in re.split(f"[{SPACE}]+", t.translate(FOLD)) if w] for i, t in before.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()) for i, w in words.items() if i is not None}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and sets[a]:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert set(after) == {i for i in ids if find(i) == i} | ({None} & set(before))


def test_near_dedup_of_rows_without_ids_of_their_own(spark):
    copy, other = "one text that several rows hold word for word", "another text of which each row lacks an id"
    rows = [(7, copy), (7, copy), (None, copy), (9, copy), (None, other), (None, other), (8, "a text that stands alone"), (3, ""), (3, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.near_dedup(spark, table, DIR).collect()]
    assert Counter(left) == Counter([(7, copy), (None, other), (8, "a text that stands alone"), (3, ""), (3, "")])


def test_decontaminate(spark, inputs):
    before, after = texts(inputs[3]), texts(inputs[4])
    squeeze = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [squeeze(r["text"]).split() for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    plain = {i: squeeze(t) for i, t in before.items()}
    for i in before:
        shares = [[" ".join(w[k : k + 8]) in plain[i] for k in range(max(0, len(w) - 7))] for w in items]
        if any(s and all(s) for s in shares):
            assert i not in after
        elif not any(sum(s) for s in shares):
            assert after[i] == before[i]


def test_packing_and_run(spark, inputs):
    rows = inputs[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts(inputs[4]))
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 2048
    whole = corpus_pipeline.run(spark, DIR)
    assert whole.columns == inputs[5].columns
    assert {r["doc_id"] for r in whole.collect()} == {r["doc_id"] for r in rows} - {None}


def test_empty_table(spark):
    frame = spark.read.parquet(f"{DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        frame = saved(stage(spark, frame, DIR))
    assert frame.count() == 0
