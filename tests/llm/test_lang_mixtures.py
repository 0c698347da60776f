"""Language mixtures against a plain version: one text, one word and one trigram at a time."""

from __future__ import annotations

import math

import numpy as np
import pytest

from gatelens.llm.lang_id import BUCKETS, TRACE, UNKNOWN, identify, mixtures, train

SF = "/root/testdata/sf0.001"


def words_of(text):
    """The words' trigrams: letters are a-z and all bytes beyond ASCII, with a blank at both ends of a word."""
    word, found = [], []
    for byte in [*text.encode(), 32]:
        byte += 32 * (65 <= byte <= 90)
        if 97 <= byte <= 122 or byte >= 128:
            word.append(byte)
        elif word:
            padded = [0, *word, 0]
            found.append([tuple(padded[i : i + 3]) for i in range(len(word))])
            word = []
    return found


def bucket(trigram):
    code = trigram[0]
    for byte in trigram[1:]:
        code = (code * 0x01000193 & 0xFFFFFFFF) ^ byte
    return (code * 0x9E3779B1 & 0xFFFFFFFF) >> 16


def plain_fit(likelihoods, shares):
    for _ in range(100_000):
        sums = dict.fromkeys(shares, 0.0)
        for word in likelihoods:
            total = sum(shares[k] * word[k] for k in shares)
            for k in shares:
                sums[k] += shares[k] * word[k] / total
        after = {k: v / len(likelihoods) for k, v in sums.items()}
        moved = max(abs(after[k] - shares[k]) for k in shares)
        shares = after
        if moved < 1e-8:
            break
    return shares, sum(math.log(sum(shares[k] * word[k] for k in shares)) for word in likelihoods)


def plain_mixture(logs, langs, penalty):
    """Shares of the selected languages, given each word's log-likelihood in each language."""
    likelihoods = [{k: max(TRACE, math.exp(w[k] - max(w.values()))) for k in langs} for w in logs]
    shares, fit = plain_fit(likelihoods, {k: 1 / len(langs) for k in langs})
    while len(shares) > 1:
        least = min(shares, key=lambda k: (shares[k], langs.index(k)))
        fewer = {k: max(v, 1e-6) for k, v in shares.items() if k != least}
        new, new_fit = plain_fit(likelihoods, {k: v / sum(fewer.values()) for k, v in fewer.items()})
        if fit - new_fit >= penalty * math.log(len(likelihoods) + 1):
            break
        shares, fit = new, new_fit
    return shares


def test_whole_table_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    langs, table = train(docs.where("doc_id % 3 <> 0"))
    counts = {k: np.full(BUCKETS, 0.5) for k in langs}
    rows = docs.select("doc_id", "text", "lang").collect()
    for r in rows:
        if r["doc_id"] % 3 and r["text"] is not None and r["lang"] is not None:
            for word in words_of(r["text"]):
                for t in word:
                    counts[r["lang"]][bucket(t)] += 1
    logs = {k: np.log(c / c.sum()) for k, c in counts.items()}
    assert all(np.allclose(logs[k], table[i], atol=1e-5) for i, k in enumerate(langs))

    # The documents, and pairs of documents of different languages after each other.
    by_lang = {k: [r["text"] for r in rows if r["lang"] == k and r["text"]] for k in langs}
    mixed = [(10_000 + 10 * i + j, f"{by_lang[a][j][:400]} {by_lang[b][j][: 400 // (j + 1)]}") for i, (a, b) in enumerate(zip(langs, langs[1:] + langs[:1], strict=True)) for j in range(3)]
    texts = [(r["doc_id"], r["text"]) for r in rows] + mixed
    got = {r["doc_id"]: r for r in identify(spark.createDataFrame(texts, "doc_id long, text string"), (langs, table)).collect()}
    several = 0
    for i, text in texts:
        words = words_of(text or "")
        if not any(ch.isalpha() for ch in text or ""):
            assert got[i]["lang_pred"] == UNKNOWN and got[i]["score"] == 0
            continue
        expected = plain_mixture([{k: sum(logs[k][bucket(t)] for t in w) for k in langs} for w in words], langs, 5.0)
        shares = {s["lang"]: s["share"] for s in got[i]["languages"]}
        assert set(shares) == {k for k, v in expected.items() if v > 0}, i
        assert all(abs(shares[k] - expected[k]) < 1e-3 for k in shares), i
        assert got[i]["score"] == pytest.approx(max(expected.values()), abs=1e-3)
        several += len(shares) > 1
    assert several >= 6


def test_slow_mixtures_settle_at_the_best_shares():
    """Languages that are nearly alike: the shares move for hundreds of rounds and must reach the maximum."""
    rng = np.random.default_rng(5)
    sizes = np.array([3, 4000, 1, 700])
    words = rng.normal(0, 0.05, (3, sizes.sum())).astype(np.float32)
    words[0, 3:2003] += 0.3
    got = mixtures(words, sizes, 0.0)
    start = 0
    for k, size in enumerate(sizes.tolist()):
        own = words[:, start : start + size].astype(float)
        start += size
        expected = plain_mixture([dict(enumerate(w)) for w in own.T.tolist()], [0, 1, 2], 0.0)
        chosen = {j: float(got[j, k]) for j in range(3) if got[j, k] > 0}
        assert all(abs(chosen.get(j, 0) - expected.get(j, 0)) < 5e-3 for j in range(3)), (k, chosen, expected)


def test_long_text_keeps_its_share():
    """Sums over more words than 24 bits can count."""
    words = np.zeros((2, (1 << 24) + 1000), np.float32)
    words[1] = -50
    words[:, -500:] = words[::-1, -500:]
    got = mixtures(words, np.array([words.shape[1]]), 5.0)
    assert got[0, 0] == pytest.approx(1 - 500 / words.shape[1], abs=1e-6)
