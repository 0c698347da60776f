from __future__ import annotations

import pyarrow as pa

from gatelens.llm import common, lang_id


def test_a_worker_keeps_the_state_of_one_operator_only():
    assert common.kept("a", list) is common.kept("a", list)
    common.kept("b", dict)
    assert list(common._kept) == ["b"]
    list(lang_id._count(iter([pa.RecordBatch.from_pydict({"text": ["ein haus"], "lang": ["de"]})])))
    assert not common._kept
