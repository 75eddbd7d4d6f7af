"""What tasks leave in the Python workers that outlive them."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pytest

from lakegate.llm import minhash, packing, quality


def _batch(texts):
    ids = pa.array(range(len(texts)), pa.int64())
    row = pa.StructArray.from_arrays([ids, pa.array(texts)], names=["doc_id", "text"])
    columns = {"doc_id": ids, "_id": ids, "label": ids, "text": pa.array(texts), "row": row}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _tasks():
    return [
        minhash._signer(minhash.Settings()),
        minhash._set_maker(5),
        quality._featured,
        quality._scorer(quality.Additive(0.0)),
        packing._packer(packing.VOCABULARY, 1, 2048, None),
    ]


@pytest.mark.parametrize("which", range(5))
@pytest.mark.parametrize("early", [False, True])
def test_a_task_gives_back_what_arrow_has_freed(monkeypatch, which, early):
    released, rows = [], []
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    task = _tasks()[which](iter([_batch(["one two three"] * 3), _batch(["four", None])]))
    pool = SimpleNamespace(release_unused=lambda: released.append(sum(rows)))
    with monkeypatch.context() as patched:
        patched.setattr(pa, "default_memory_pool", lambda: pool)
        for batch in task:
            rows.append(batch.num_rows)
            if early:
                task.close()
    assert released == [sum(rows)] and sum(rows) > 0


def test_packing_holds_little_text_at_once(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = ["word " * 120_000] * 4
    pieces = list(packing._packer(packing.VOCABULARY, 1, 2048, None)(iter([_batch(texts)])))
    assert len(pieces) == 4
    found = {}
    for batch in pieces:
        for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
            found[doc] = found.get(doc, b"") + ids
    assert len(set(found.values())) == 1 and sorted(found) == [0, 1, 2, 3]
    numbers = [n for b in pieces for n in b.column("sequence_id").to_pylist()]
    assert numbers == list(range(len(numbers)))
