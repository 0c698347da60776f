"""Secret links against all pairs; licence scans of texts with long runs."""

from __future__ import annotations

import random
import re
import textwrap

from gatelens.llm.decontaminate import contaminated
from gatelens.llm.licenses import scan_licenses
from gatelens.llm.secrets import ACCESS, ACCOUNT, ASSIGN, ASSIGN_VALUE, ENDPOINT, HEX, KEY, find_secrets

ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "key": "secret", "account": "identifier", "endpoint": "endpoint"}
ALONE = ("assign", "access", "hex")


def spans_of(text, scope):
    """All findings by comparing every two parts."""
    parts = []
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("key", KEY), ("account", ACCOUNT), ("endpoint", ENDPOINT)):
        for m in re.finditer(pattern, text):
            if kind == "assign" and len(m[2]) < ASSIGN_VALUE:
                continue
            if kind == "key" and not all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
                continue
            parts.append((m.start(), m.end(), kind))
    found = set()
    for start, end, kind in parts:
        others = [
            o for o in parts if (ROLES[o[2]] == "secret") != (ROLES[kind] == "secret") and o[0] <= end + scope and o[1] >= start - scope and (o[1] <= start or o[0] >= end)
        ]
        if kind in ALONE or others:
            found.add((start, end, kind))
    return found


def test_op7_links_against_all_pairs(spark):
    rng = random.Random(11)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def piece():
        key = "".join(rng.choice(letters) for _ in range(rng.choice([31, 32, 40])))
        return rng.choice([
            key, "user_name = bob.smith", "https://example.org/path?x=1", f"https://example.org/{key}", "password: hunter22x", "token=abc", "AKIA" + "A1B2" * 4, "0123456789abcdef" * 2, "login:ann",
            "postgres://db.internal:5432/main", f"client_id={key}", "word " * rng.randrange(1, 90), "\n", "é" * rng.randrange(1, 60), "x" * rng.randrange(1, 300),
        ])

    texts = [(n, " ".join(piece() for _ in range(rng.randrange(1, 14)))) for n in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for scope in (20, 200):
        got = {r["doc_id"]: {(f["start"], f["end"], f["name"]) for f in r["findings"]} for r in find_secrets(docs, scope=scope).collect()}
        want = {n: spans_of(text, scope) for n, text in texts}
        assert got == want
        assert any(kind not in ALONE for found in want.values() for _, _, kind in found)


def test_op7_one_string_is_not_two_parts(spark):
    docs = spark.createDataFrame([(1, "https://example.org/Wiki/Article2024/SomeLongPathSegmentHere"), (2, "see https://example.org/a key Abcdefghijklmnopqrstuvwxyz012345678")], "doc_id long, text string")
    got = {r["doc_id"]: [f["name"] for f in r["findings"]] for r in find_secrets(docs).collect()}
    assert got == {1: [], 2: ["endpoint", "key"]}


def test_op8_long_runs(spark):
    """A megabyte of comment signs or of dotted tokens beside a notice."""
    notice = "Released under the MIT License."
    texts = [(n, run * (1_000_000 // len(run)) + end + notice) for n, (run, end) in enumerate([("# ", "\n"), ("* ", "\n"), ("1.", " "), ("a-", "\n"), ("// ", "\n# "), ("-- # ", "\n"), ("x ", "\n")])]
    files = spark.createDataFrame([(n, text, f"src/{n}") for n, text in texts], "doc_id long, text string, path string").repartition(7)
    got = {r["doc_id"]: (r["license"], r["basis"]) for r in scan_licenses(files, "path").collect()}
    # Signs are no tokens, so such a text is all notice; a dotted run is one token more, with a cosine of 0.78.
    assert got == {n: ("MIT", "header" if n == 6 else "file") for n in range(7)}


def test_op3_frequent_lines_are_dealt_out(spark, monkeypatch):
    """A line of all documents, and one of half of them: the same result whatever the number of tasks is, and no task of
    the join gets them all."""
    from gatelens.llm import line_dedup

    rng = random.Random(4)
    texts = [(n, "\n".join(["the line of all documents"] * (1 + n % 3) + ["the line of the half of them"] * (n % 2) + [f"an own line {rng.random()}" for _ in range(5)])) for n in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    results = []
    for shares in (1, 10, 1000):
        monkeypatch.setattr(line_dedup, "SHARES", shares)
        results.append(sorted(tuple(r) for r in line_dedup.dedup_lines(docs).collect()))
    assert results[0] == results[1] == results[2]
    assert [r[3] for r in results[0][:4]] == [0, 2, 3, 2] and sum(r[3] for r in results[0]) == sum(1 + n % 3 + n % 2 for n in range(600)) - 2
    # The keepers of a frequent key are there once per task.
    text = line_dedup.dedup_lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(0, (_tasks" in text


def test_op8_near_relations(spark):
    """Licences that share most of their words, whole bodies, and SPDX tags."""
    from gatelens.llm import licenses as L

    holder, code = "Copyright (c) 2020, Somebody\n\n", "static int counted(struct tree *node, int depth);\n" * 30
    commented = lambda text: "/*\n" + "".join(f" * {line}\n" for line in textwrap.wrap(text, 60)) + " */\n" + code
    two, three = f"{L._BSD_2}\n\n{L._BSD_END}", f"{L._BSD_2}\n{L._BSD_3}\n\n{L._BSD_END}"
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    files = [
        (1, holder + two, "BSD-2-Clause", "file"), (2, holder + three, "BSD-3-Clause", "file"), (3, holder + L._MIT, "MIT", "file"), (4, holder + L._ISC, "ISC", "file"), (5, L._UNLICENSE, "Unlicense", "file"),
        (6, commented(two), "BSD-2-Clause", "header"), (7, commented(three), "BSD-3-Clause", "header"),
        (8, commented(gnu.format("Affero General Public License", "3")), "AGPL-3.0", "header"), (9, commented(gnu.format("General Public License", "3")), "GPL-3.0", "header"),
        (10, commented(gnu.format("Lesser General Public License", "2.1").replace("program", "library")), "LGPL-2.1", "header"),
        (11, commented(gnu.format("Lesser General Public License", "3").replace("program", "library")), "LGPL-3.0", "header"),
        (12, "# SPDX-License-Identifier: MIT\n" + code, "MIT", "header"), (13, "// SPDX-License-Identifier: (GPL-2.0-only OR BSD-2-Clause)\n" + code, "GPL-2.0", "header"),
        (14, "                  GNU AFFERO GENERAL PUBLIC LICENSE\n                     Version 3, 19 November 2007\n" + "words of the preamble\n" * 9, "AGPL-3.0", "header"),
        (15, "                  GNU LESSER GENERAL PUBLIC LICENSE\n                     Version 2.1, February 1999\n" + "words of the preamble\n" * 9, "LGPL-2.1", "header"),
        (16, "SPDX-License-Identifier:\n" + code, None, None), (17, code, None, None),
    ]
    rows = spark.createDataFrame([(i, f"d{i}/x", t) for i, t, _, _ in files], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["basis"]) for r in scan_licenses(rows, "path").collect()}
    assert got == {i: (name, basis) for i, _, name, basis in files}


def test_op8_against_all_cosines(spark):
    """Each file's licence against cosines of dictionaries; directories against a climb, with one that holds most files."""
    import math
    import re
    from collections import Counter

    from gatelens.llm import licenses as L

    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    files = [(i, f"big/{i % 3}/f{i}" if i % 5 else f"small/{i}/f", t) for i, t in enumerate(texts * 2)]
    files += [(1000, "big/LICENSE", "Released under the MIT License."), (1001, "small/5/COPYING", L._ISC), (1002, "big/1/LICENSE", L._UNLICENSE)]
    words = lambda text: Counter(re.findall(L.TOKEN, text.lower()))
    templates = [(name, words(text)) for name, text in L.TEMPLATES]
    spread = Counter(t for _, c in templates for t in c)
    weigh = lambda c: {t: n * (math.log((1 + len(templates)) / (1 + spread.get(t, 0))) + 1) for t, n in c.items()}
    size = lambda v: math.sqrt(sum(w * w for w in v.values()))
    vectors = [(name, weigh(c)) for name, c in templates]

    def best(text):
        v = weigh(words(text))
        return min(((-round(sum(w * t.get(x, 0) for x, w in v.items()) / size(v) / size(t), 6), name) for name, t in vectors), default=(0, "")) if v else (0, "")

    expected = {}
    for i, path, text in files:
        whole = best(text)
        lines = [x for line in text.split("\n") for x in re.split(r"(?<=[.!?;])\s+", line)]
        headers = min((b for b in map(best, lines) if b[0] <= -0.75), default=None)
        expected[i] = (whole[1], "file") if whole[0] <= -0.75 else (headers[1], "header") if headers else (None, None)
    givers = {"/".join(p.split("/")[:-1]): expected[i][0] for i, p, _ in files if i >= 1000}
    rows = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r["doc_id"]: r for r in scan_licenses(rows, "path").collect()}
    for i, path, _ in files:
        name, basis = expected[i]
        if basis is None:
            parts = path.split("/")[:-1]
            above = [d for d in ("/".join(parts[:n]) for n in range(len(parts), -1, -1)) if d in givers]
            source = above[0] if above else None
            assert (got[i]["license"], got[i]["basis"], got[i]["source_dir"]) == ((givers[source], "inherited", source) if source else (None, None, None))
        else:
            assert (got[i]["license"], got[i]["basis"]) == (name, basis), i


def test_op4_number_words_and_other_scripts(spark):
    apples = "if you have three apples and buy seven more apples and then eat four of the apples how many are left"
    russian = "вчера вечером Иван купил на рынке много свежих яблок и потом отдал половину из них своей сестре Марии"
    digits = "एक दुकान में ३५ किताबें हैं और उनमें से १२ किताबें बिक गईं तो बताओ अब कितनी बची हैं"
    items = spark.createDataFrame([(1, apples), (2, russian), (3, digits)], "item_id long, text string")
    texts = [
        (1, apples.replace("three", "five").replace("seven", "nine").replace("four", "twenty-two")), (2, russian.replace("Иван", "Пётр").replace("Марии", "Анне")),
        (3, digits.replace("३५", "९०").replace("१२", "४")), (4, apples), (5, "three of them had four apples and that was all there was to say about these seven trees"), (6, russian.upper()),
    ]
    found = contaminated(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["kind"]) for r in found) == [(1, 1, "variant"), (2, 2, "variant"), (3, 3, "variant"), (4, 1, "exact"), (6, 2, "exact")]


def test_language_filter_takes_any_column_names(spark):
    from gatelens.llm.lang_id import keep_identified, train

    rows = [(i, "the cat and the dog are in the house" if i % 2 else "1 2 3", "en", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, `a.b` long")
    kept = keep_identified(docs, train(docs))
    assert kept.columns == docs.columns and {r["a.b"] for r in kept.collect()} == set(range(1, 20, 2))
