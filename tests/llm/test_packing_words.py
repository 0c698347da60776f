from __future__ import annotations

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gatelens.llm import packing
from gatelens.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/word_bpe_49k.json"
WORDS = (
    "Haus haus*** Haus$$$ haus.%%% don't don't*** l'été été!!! ÉTÉ ÿ ß straße*** × a× ×*** µ ª İ Ⅷ ﬁ é é*** x<|endoftext|> "
    "<|endoftext|>*** <|ENDOFTEXT|> word's 's *** ' '' a' a_ a__b a1 1a x.33@mail9.example.com 漢字 漢字*** naïve, déjà-vu. (so) zzzzqqqq"
).split() + ["*" * 30, "haus" + "-" * 30]


@pytest.mark.parametrize("slot_bits", [1, 21])
@pytest.mark.parametrize("direct", [True, False])
def test_ids_are_those_of_the_tokenizer(monkeypatch, slot_bits, direct):
    monkeypatch.setattr(packing, "SLOT_BITS", slot_bits)
    words = packing._WordIds(PATH, 0)
    assert words.model is not None
    if not direct:
        words.model = None
    texts = [" ".join(WORDS), None, "", "\t\n", *WORDS, *reversed(WORDS), " ".join(WORDS).upper()]
    plain = Tokenizer.from_file(PATH)
    for _ in range(2):
        ids, edges = words.of(pa.array(texts, pa.string()))
        for n, text in enumerate(texts):
            assert ids[edges[n] : edges[n + 1]].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 0], text


def test_words_are_tokenized_once_without_their_marks():
    words = packing._WordIds(PATH, 0)
    words.of(pa.array(["Haus haus*** HAUS.%%% été été!!!", "haus"]))
    assert words.words == 5  # two words, three runs of marks
    words.of(pa.array(["haus*** été.%%%"]))
    assert words.words == 5
