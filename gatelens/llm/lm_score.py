"""Documents scored by a smoothed n-gram model, run as a weighted automaton with failure arcs.

Texts are read once into blocks: the numbers of a block's words in the block's own vocabulary. Counts leave a block as
packed messages, one per block and part of the model. First the words: a part adds them up and numbers them through the
corpus, so that n-grams travel as sorted small numbers and not as hashes. Then the n-grams: a part holds the n-grams that
begin with the same word, so that the totals of histories lie beside those of their n-grams; after histories of frequent
words only, every n-gram is dealt by itself, and what follows such a history is added up over the parts. Every part answers
each message with the totals over the corpus, in the order of the message. No model is ever held whole.

The model: single words have add-0.1 probabilities. A longer n-gram seen in training is an arc from the state of its
history: probability ``(c(hw) - D) / c(h) + l(h) p(w | shorter h)``. The failure arc of a state weighs ``l(h)``, what the
discounts left over, and leads to the state without its oldest word. Probabilities of a state sum to one. Of its n-grams
and their totals a block builds the states and arcs that its texts can meet, and one traversal from left to right carries
the state and adds up the weights. The texts of a block go side by side, long ones in pieces: a state is the longest known
n-gram that ends here, so a piece that begins ``order - 1`` tokens early arrives in the state of the whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import give_back, hashed_words, mix, row_slices, saved, ship

#: Text bytes per block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: The token that ends a document, among the hashes of words.
END = 0x0E2D_0F7E_47A1_1D0C
DISCOUNT, ADDED = 0.75, 0.1
#: Tokens for each part of the model, which one task adds up; and for each part of the words.
PART_TOKENS, WORD_TOKENS = 2_000_000, 8_000_000
#: Words that make up this share of training are frequent: 1,000 words at most, and 1,000,000 pairs of them.
FREQUENT = 1e-3
#: Tokens of a text that are traversed in one go.
PIECE = 512
_CODEC = "zstd"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their ids, lengths, and token numbers in a vocabulary ordered by frequency in the block."""
    first = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in row_slices(batch, "text", BLOCK_BYTES):
            words, edges = hashed_words(part.column("text"))
            ends = edges[1:] + np.arange(len(edges) - 1)
            tokens = np.insert(words, edges[1:], np.uint64(END))
            vocabulary, numbers, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            packed = pa.compress(place[numbers].tobytes(), codec=_CODEC, asbytes=True)
            sizes = np.diff(np.concatenate([[-1], ends])).astype(np.int32)
            held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
            one = lambda x, kind: pa.array([x], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    one(first, pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id")),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("held")),
                    one(sizes, pa.list_(pa.int32())),
                    one(packed, pa.binary()),
                    one(vocabulary[order].tobytes(), pa.binary()),
                    one(int(sizes[~held].sum()), pa.int64()),
                ],
                names=["block", "ids", "held", "sizes", "tokens", "words", "training"],
            )
            first += 1


def _pack(numbers: list[np.ndarray]) -> bytes:
    """Arrays of 4- or 8-byte numbers, compressed; like bytes of the numbers lie together."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in numbers]
    return pa.compress(b"".join(planes), codec=_CODEC, asbytes=True)


def _unpack(data: bytes, kinds: list[tuple[type, int]]) -> list[np.ndarray]:
    """What ``_pack`` packed, given the kinds and lengths."""
    flat = pa.decompress(data, sum(np.dtype(k).itemsize * n for k, n in kinds), codec=_CODEC, asbytes=True)
    out, start = [], 0
    for kind, n in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(flat, np.uint8, width * n, start).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        start += width * n
    return out


class _Grams(NamedTuple):
    """A block's distinct n-grams of one length by history and last word, ``codes`` of both in order, and their counts."""

    codes: np.ndarray
    history: np.ndarray
    last: np.ndarray
    counts: np.ndarray


class _Block:
    """A block's arrays. Words bear the block's own numbers until ``renumber`` orders them by those of the corpus."""

    def __init__(self, row: dict):
        self.block, self.ids = row["block"], row.get("ids")
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        self.tokens = np.frombuffer(pa.decompress(row["tokens"], int(self.sizes.sum()) * 4, codec=_CODEC), np.int32)
        self.training = np.repeat(~self.held, self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def renumber(self, sizes: list[list[int]], answers: list[bytes]) -> None:
        """Takes the words' numbers (-1: not in training) and totals from the answers to the block's messages."""
        count = sum(n for n, in sizes)
        numbers, totals = np.empty(count, np.int64), np.empty(count, np.int64)
        for (n,), data in zip(sizes, answers, strict=True):
            steps, number, total = _unpack(data, [(np.int32, n), (np.int64, n), (np.int64, n)])
            places = np.cumsum(steps)
            numbers[places], totals[places] = number, total
        order = np.argsort(numbers, kind="stable")
        place = np.empty(count, np.int32)
        place[order] = np.arange(count, dtype=np.int32)
        self.tokens, self.numbers, self.totals = place[self.tokens], numbers[order], totals[order]

    def grams(self, lexicon: np.ndarray | None, order: int) -> list[_Grams]:
        """The distinct n-grams within documents, from the shorter to the longer, of training's words or the lexicon's."""
        inside = self.numbers >= 0
        if lexicon is not None:
            inside &= np.isin(self.numbers, lexicon)
        first = np.zeros(len(self.tokens), bool)
        first[self.starts] = True
        known = inside[self.tokens]
        at, out = np.where(known, self.tokens, -1).astype(np.int32), []
        for _ in range(2, order + 1):
            history = np.insert(at[:-1], 0, -1)
            history[first] = -1
            ends = np.flatnonzero((history >= 0) & known)
            codes, inverse = np.unique(history[ends].astype(np.int64) * len(inside) + self.tokens[ends], return_inverse=True)
            counts = np.bincount(inverse, weights=self.training[ends], minlength=len(codes)).astype(np.int32)
            at = np.full(len(self.tokens), -1, np.int32)
            at[ends] = inverse
            out.append(_Grams(codes, (codes // len(inside)).astype(np.int32), (codes % len(inside)).astype(np.int32), counts))
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            give_back()


# Words ----------------------------------------------------------------------------------------------------------


def _word_messages(row: dict, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Per part: its number of words, and the words' places in the block's vocabulary, their hashes and counts in training."""
    block, words = _Block(row), np.frombuffer(row["words"], np.uint64)
    counts = np.bincount(block.tokens[block.training], minlength=len(words)).astype(np.int32)
    of = (words % np.uint64(parts)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    present, low = np.unique(of[order], return_index=True)
    for part, places in zip(present.tolist(), np.split(order, low[1:]), strict=True):
        yield part, len(places), _pack([np.diff(places, prepend=0).astype(np.int32), words[places], counts[places]])


def _sum_words(parts: int, lexicon: int | None):
    """Adds up a part's words and answers each message: per word its number in the corpus and its total. Frequent words have
    low numbers. One row without a block tells how many words the part has, and the most frequent ones if asked."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        blocks, sizes, found = table.column("block").to_pylist(), table.column("sizes").to_pylist(), []
        for (n,), data in zip(sizes, table.column("data"), strict=True):
            found.append(_unpack(data.as_py(), [(np.int32, n), (np.uint64, n), (np.int32, n)]))
        keys, inverse = np.unique(np.concatenate([f[1] for f in found]), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([f[2] for f in found]), minlength=len(keys)).astype(np.int64)
        order = np.lexsort((keys.view(np.int64), -total))
        number = np.empty(len(keys), np.int64)
        number[order] = np.arange(len(keys)) * parts + part
        number[total == 0] = -1
        top = [{"number": int(number[i]), "total": int(total[i]), "key": int(keys.view(np.int64)[i])} for i in order[: lexicon or 0] if total[i]]
        answers = [_pack([f[0], number[i], total[i]]) for f, i in zip(found, np.split(inverse, np.cumsum([n for n, in sizes])[:-1]), strict=True)]
        give_back()
        return pa.table(
            [
                pa.array([*blocks, None], pa.int64()),
                pa.array([-1 - part] * (len(blocks) + 1), pa.int32()),
                pa.array([*sizes, None], pa.list_(pa.int32())),
                pa.array([*answers, None], pa.binary()),
                pa.array([None] * len(blocks) + [int((total > 0).sum())], pa.int64()),
                pa.array([None] * len(blocks) + [top], pa.list_(pa.struct([("number", pa.int64()), ("total", pa.int64()), ("key", pa.int64())]))),
            ],
            names=["block", "part", "sizes", "data", "distinct", "top"],
        )

    return run


# N-grams --------------------------------------------------------------------------------------------------------


class _Dealt(NamedTuple):
    """The n-grams of one length (or words) by part: for each part those beside their history, then those by themselves."""

    order: np.ndarray
    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray


class _Deal:
    """Which part of the model a block's n-grams belong to."""

    def __init__(self, block: _Block, grams: list[_Grams], parts: int, often: float):
        frequent = block.totals >= often
        self.keys, self.spread = [mix(block.numbers.view(np.uint64))], [frequent]
        of, ofs = (self.keys[0] % np.uint64(parts)).astype(np.int64), []
        begins = np.zeros(len(frequent), bool)
        if grams:
            begins[grams[0].history] = True
        chosen = [np.flatnonzero(begins & ~frequent)]
        ofs.append(2 * of[chosen[0]])
        for k, g in enumerate(grams):
            alone = self.spread[k][g.history]
            self.keys.append(mix(self.keys[k][g.history] + block.numbers[g.last].view(np.uint64)))
            of = np.where(alone, (self.keys[k + 1] % np.uint64(parts)).astype(np.int64), of[g.history])
            # Histories of up to two frequent words spread what follows them.
            self.spread.append(alone & frequent[g.last] if k == 0 else np.zeros(len(alone), bool))
            chosen.append(np.arange(len(of)))
            ofs.append(2 * of + alone)
        self.present = np.unique(np.concatenate(ofs) // 2)
        self.levels = []
        for rows, code in zip(chosen, ofs, strict=True):
            order = np.argsort(code, kind="stable")
            code = code[order]
            self.levels.append(_Dealt(rows[order], *(np.searchsorted(code, 2 * self.present + x) for x in (0, 1, 2))))

    def of_part(self, i: int) -> list[np.ndarray]:
        return [d.order[d.low[i] : d.high[i]] for d in self.levels]


def _messages(block: _Block, grams: list[_Grams], deal: _Deal) -> Iterator[tuple[int, list[int], bytes]]:
    """Per part: its first words; then its n-grams by the place of their history or, of those dealt by themselves, its key,
    by last word and count. Sizes are those of the lists."""
    places = []
    for d, n in zip(deal.levels, [len(block.numbers), *(len(g.last) for g in grams)], strict=True):
        place = np.zeros(n, np.int32)
        place[d.order] = np.arange(len(d.order)) - np.repeat(d.low, d.high - d.low)
        places.append(place)
    for i, part in enumerate(deal.present.tolist()):
        words, *mine = deal.of_part(i)
        sizes, numbers = [len(words)], [np.diff(block.numbers[words], prepend=0)]
        for k, (g, m) in enumerate(zip(grams, mine, strict=True)):
            beside = int(deal.levels[k + 1].middle[i] - deal.levels[k + 1].low[i])
            sizes += [beside, len(m) - beside]
            numbers += [np.diff(places[k][g.history[m[:beside]]], prepend=np.int32(0)), deal.keys[k][g.history[m[beside:]]], block.numbers[g.last[m]], g.counts[m]]
        yield part, sizes, _pack(numbers)


def _sum_part(min_count: int, order: int):
    """Adds up a part's messages and answers each: per n-gram its total, 0 if it is not in the model; per history, how many
    tokens and how many n-grams of the model follow it. Rows without a block tell this of histories that are spread."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        blocks, sizes, found = table.column("block").to_pylist(), table.column("sizes").to_pylist(), []
        for n, data in zip(sizes, table.column("data"), strict=True):
            kinds = [(np.int64, n[0])]
            for beside, alone in zip(n[1::2], n[2::2], strict=True):
                kinds += [(np.int32, beside), (np.uint64, alone), (np.int64, beside + alone), (np.int32, beside + alone)]
            found.append(_unpack(data.as_py(), kinds))
        numbers = [np.cumsum(f[0]) for f in found]
        distinct, inverse = np.unique(np.concatenate(numbers), return_inverse=True)
        count, at = len(distinct), np.split(inverse, np.cumsum([len(x) for x in numbers])[:-1])
        answers: list[list[np.ndarray]] = [[] for _ in blocks]
        spread, rests = [], None
        for k in range(order - 1):
            steps, keys, lasts, counts = ([f[1 + 4 * k + x] for f in found] for x in range(4))
            hot, hot_of = np.unique(np.concatenate(keys), return_inverse=True)
            hot_of = np.split(hot_of + count, np.cumsum([len(x) for x in keys])[:-1])
            history = np.concatenate([np.concatenate([a[np.cumsum(s)], h]) for a, s, h in zip(at, steps, hot_of, strict=True)])
            last = np.concatenate(lasts)
            width = int(last.max()) + 1 if len(last) else 1
            distinct, inverse = np.unique(history * width + last, return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
            total[total < max(1, min_count)] = 0
            followed = np.bincount(distinct // width, weights=total, minlength=count + len(hot)).astype(np.int64)
            followers = np.bincount(distinct // width, weights=total > 0, minlength=count + len(hot)).astype(np.int64)
            spread.append((k, hot, followed[count:], followers[count:]))
            # What doesn't follow a history is 0 as a rule and packs well; of words the block knows the totals itself.
            tell = followed[:count] if rests is None else rests - followed[:count]
            pieces = np.split(inverse, np.cumsum([len(x) for x in lasts])[:-1])
            for answer, a, piece in zip(answers, at, pieces, strict=True):
                answer += [tell[a], followers[a].astype(np.int32), total[piece]]
            at, count, rests = pieces, len(distinct), total
        n, none = len(blocks), lambda m, kind: pa.nulls(m, kind)
        out = [pa.table([pa.array(blocks, pa.int64()), pa.array([part] * n, pa.int32()), pa.array([_pack(a) for a in answers], pa.binary()), none(n, pa.int32()), none(n, pa.int64()), none(n, pa.int64()), none(n, pa.int64())], names=_ANSWER)]
        for k, hot, followed, followers in spread:
            m = len(hot)
            out.append(pa.table([none(m, pa.int64()), none(m, pa.int32()), none(m, pa.binary()), pa.array(np.full(m, k, np.int32)), pa.array(hot.view(np.int64)), pa.array(followed), pa.array(followers)], names=_ANSWER))
        give_back()
        return pa.concat_tables(out)

    return run


_ANSWER = ["block", "part", "data", "level", "key", "followed", "followers"]


class _Automaton:
    """States and arcs that a block's texts can meet. A state is a level (words of its history) and a place there: the word's
    number in the block, or its n-gram's. Level 0 has one state, before which nothing is known."""

    def __init__(self, block: _Block, grams: list[_Grams], deal: _Deal, answers: dict[int, bytes], spread: list[tuple[np.ndarray, ...]], base: np.ndarray):
        self.width, self.top = len(block.numbers), len(grams)
        totals = [block.totals, *(np.zeros(len(g.last), np.int64) for g in grams)]
        followed, followers = ([np.zeros(len(t), np.int64) for t in totals] for _ in range(2))
        for i, part in enumerate(deal.present.tolist()):
            lists = deal.of_part(i)
            kinds = [kind for a, b in zip(lists, lists[1:], strict=False) for kind in ((np.int64, len(a)), (np.int32, len(a)), (np.int64, len(b)))]
            values = _unpack(answers[part], kinds)
            for k, (a, b) in enumerate(zip(lists, lists[1:], strict=False)):
                tell, n, total = values[3 * k : 3 * k + 3]
                followed[k][a], followers[k][a], totals[k + 1][b] = (tell if k == 0 else totals[k][a] - tell), n, total
        for k, (keys, tokens, n) in enumerate(spread[: self.top]):
            mine = np.flatnonzero(deal.spread[k])
            if len(keys) and len(mine):
                at = np.minimum(np.searchsorted(keys, deal.keys[k][mine]), len(keys) - 1)
                there = keys[at] == deal.keys[k][mine]
                followed[k][mine], followers[k][mine] = np.where(there, tokens[at], 0), np.where(there, n[at], 0)
        left = [1 - (f - DISCOUNT * n) / np.maximum(t, 1) for f, n, t in zip(followed, followers, totals, strict=True)]
        self.known, self.base = block.totals > 0, np.log10(base)
        #: By level of the state an arc leaves: codes of state and word, whether training has the arc, its weight, where it leads.
        self.codes, self.there, self.weight, self.shorter = [], [], [], []
        below, lower = base, None
        for k, g in enumerate(grams):
            # The same words without the first: a word, or an arc of the level below.
            shorter = g.last if k == 0 else np.searchsorted(self.codes[k - 1], lower[g.history].astype(np.int64) * self.width + g.last)
            p = np.where(totals[k + 1] > 0, totals[k + 1] - DISCOUNT, 0) / np.maximum(totals[k][g.history], 1) + left[k][g.history] * below[shorter]
            self.codes.append(g.codes), self.there.append(totals[k + 1] > 0), self.weight.append(np.log10(p)), self.shorter.append(shorter)
            below, lower = p, shorter
        self.failure = [np.log10(x) for x in left]

    def read(self, block: _Block) -> np.ndarray:
        """The log10 probability of every token, in one traversal from left to right, all pieces of texts side by side."""
        pieces = -(-block.sizes // PIECE)
        text = np.repeat(np.arange(len(pieces)), pieces)
        begin = block.starts[text] + PIECE * (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        end = np.minimum(begin + PIECE, (block.starts + block.sizes)[text])
        early = np.maximum(begin - self.top, block.starts[text])
        order = np.argsort(early - end, kind="stable")
        begin, end, early = begin[order], end[order], early[order]
        lengths, out = end - early, np.empty(len(block.tokens))
        level, state = np.zeros(len(order), np.int8), np.zeros(len(order), np.int64)
        for step in range(int(lengths[0]) if len(order) else 0):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            at = early[:active] + step
            words, weight = block.tokens[at], np.zeros(active)
            on, of = level[:active], state[:active]
            moving = np.ones(active, bool)
            for k in range(self.top, 0, -1):
                here = np.flatnonzero(moving & (on == k))
                if not len(here):
                    continue
                code = of[here] * self.width + words[here]
                arc = np.searchsorted(self.codes[k - 1], code)
                arc[arc == len(self.codes[k - 1])] = 0
                taken = (self.codes[k - 1][arc] == code) & self.there[k - 1][arc] if len(self.codes[k - 1]) else np.zeros(len(here), bool)
                go, arc, fail = here[taken], arc[taken], here[~taken]
                weight[go] += self.weight[k - 1][arc]
                on[go], of[go] = (k + 1, arc) if k < self.top else (k, self.shorter[k - 1][arc])
                moving[go] = False
                weight[fail] += self.failure[k - 1][of[fail]]
                of[fail], on[fail] = (self.shorter[k - 2][of[fail]] if k > 1 else 0), k - 1
            here = np.flatnonzero(moving)
            weight[here] += self.base[words[here]]
            of[here], on[here] = words[here], self.known[words[here]] & (self.top > 0)
            scored = at >= begin[:active]
            out[at[scored]] = weight[scored]
        return out


def score(
    docs: DataFrame, order: int = 3, lexicon: int | None = None, min_count: int = 1, held_out: int = 10, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """log10 probabilities of all texts: (id_column, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Rows whose crc32 of the id as text leaves a remainder other than 0 on division by ``held_out`` are learned from. Tokens
    are words (A-Z lower-cased) and one end per text. ``base_score`` is that of single words alone. N-grams are made of all
    words, or of the ``lexicon`` most frequent ones if it is given, and count if training holds them ``min_count`` times.

    Defined cases: a null or empty text is its end alone; a null id counts as empty text (its remainder is 0: held out);
    rows that repeat or share an id are learned from and scored each; equally frequent words enter the lexicon in the
    order of their hashes. Without training rows all words are unseen. An empty table gives an empty result. Other
    columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = dict(docs.dtypes)[id_column]
    ident = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), (F.crc32(ident) % held_out == 0).alias("held"))
    columns = f"block long, ids array<{id_type}>, held array<boolean>, sizes array<int>, tokens binary, words binary, training long"
    blocks = saved(rows.mapInArrow(_encode, columns))
    of_all = F.aggregate("sizes", F.lit(0).cast("long"), lambda x, n: x + n)
    tokens, train_tokens = blocks.agg(F.coalesce(F.sum(of_all), F.lit(0)), F.coalesce(F.sum("training"), F.lit(0))).first()
    message, answer = "part int, block long, sizes array<int>, data binary", "block long, part int, data binary"

    word_parts = max(1, math.ceil(tokens / WORD_TOKENS))

    def send_words(batches):
        for row in _blocks(batches):
            for part, size, data in _word_messages(row, word_parts):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([row["block"]]), pa.array([[size]], pa.list_(pa.int32())), pa.array([data], pa.binary())], names=["part", "block", "sizes", "data"])

    top = "array<struct<number: long, total: long, key: long>>"
    of_words = saved(
        blocks.select("block", "held", "sizes", "tokens", "words").mapInArrow(send_words, message).groupBy("part")
        .applyInArrow(_sum_words(word_parts, lexicon), f"block long, part int, sizes array<int>, data binary, distinct long, top {top}")
    )
    distinct = of_words.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0]
    chosen = None
    if lexicon is not None:  # a bounded number of words
        best = of_words.where("block is null").select(F.explode("top").alias("t")).select("t.*").orderBy(F.desc("total"), "key").limit(lexicon)
        chosen = np.sort(np.array([r["number"] for r in best.collect()], np.int64))
    named = of_words.where("block is not null").select("block", "part", "sizes", "data")

    parts = max(1, math.ceil(tokens / PART_TOKENS))
    often = max(FREQUENT * train_tokens, PART_TOKENS / 100)

    def opened(left: pa.Table, right: pa.Table) -> Iterator[tuple[_Block, list[_Grams], _Deal, dict[int, bytes]]]:
        """A block, its n-grams, the parts they belong to, and the parts' answers."""
        rows = right.select(["part", "sizes", "data"]).to_pylist()
        mine = [r for r in rows if r["part"] < 0]
        for row in left.to_pylist():
            block = _Block(row)
            block.renumber([r["sizes"] for r in mine], [r["data"] for r in mine])
            grams = block.grams(chosen, order)
            yield block, grams, _Deal(block, grams, parts, often), {r["part"]: r["data"] for r in rows if r["part"] >= 0}

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(part, b.block, sizes, data) for b, grams, deal, _ in opened(left, right) for part, sizes, data in (_messages(b, grams, deal) if grams else ())]
        give_back()
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.binary()]
        return pa.table([pa.array([m[i] for m in out], kind) for i, kind in enumerate(kinds)], names=["part", "block", "sizes", "data"])

    texts = blocks.select("block", "held", "sizes", "tokens")
    messages = texts.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(send, message)
    answered = saved(messages.groupBy("part").applyInArrow(_sum_part(min_count, order), f"{answer}, level int, key long, followed long, followers long"))
    # Histories of frequent words only: at most 1,000 words and 1,000,000 pairs, whatever the corpus.
    hot = answered.where("block is null").groupBy("level", "key").agg(F.sum("followed").alias("followed"), F.sum("followers").alias("followers")).toArrow()
    spread = []
    for k in range(order - 1):
        level = hot.filter(pa.array(hot.column("level").to_numpy() == k))
        keys = level.column("key").to_numpy().view(np.uint64)
        by_key = np.argsort(keys)
        spread.append((keys[by_key], level.column("followed").to_numpy()[by_key], level.column("followers").to_numpy()[by_key]))

    divisor = train_tokens + ADDED * (distinct + 1)

    def score_block(left: pa.Table, right: pa.Table) -> pa.Table:
        id_kind, out = left.schema.field("ids").type.value_type, []
        for b, grams, deal, answers in opened(left, right):
            base = (b.totals + ADDED) / divisor
            base_scores = np.add.reduceat(np.log10(base)[b.tokens], b.starts)
            n_known = np.add.reduceat((b.totals > 0)[b.tokens].astype(np.int64), b.starts)
            scores = np.add.reduceat(_Automaton(b, grams, deal, answers, spread, base).read(b), b.starts)
            out.append(pa.table([pa.array(b.ids, id_kind), pa.array(b.held), pa.array(b.sizes), pa.array(n_known), pa.array(base_scores), pa.array(scores, pa.float64())], names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"]))
        give_back()
        schema = pa.schema([("id", id_kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.concat_tables(out) if out else schema.empty_table()

    wanted = named.unionByName(answered.where("block is not null").select("block", "part", F.lit(None).cast("array<int>").alias("sizes"), "data"))
    texts = blocks.select("block", "ids", "held", "sizes", "tokens")
    scored = texts.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(score_block, f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_column), "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
