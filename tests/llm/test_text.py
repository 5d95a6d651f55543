from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import text as t

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAzZ é\t\n\x0b\x1c ß.", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(texts)
def test_words_are_those_of_bytes_split(column):
    hashes, offsets = t.words(pa.array(column, pa.string()))
    want = [(x or "").encode().lower().split() for x in column]
    assert np.diff(offsets).tolist() == [len(w) for w in want]
    seen: dict = {}
    for h, w in zip(hashes.tolist(), [w for row in want for w in row], strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_pieces_and_slices_do_not_change_words(monkeypatch):
    column = pa.array([" ".join(f"word{i}" for i in range(500)), "y" * 900, None, "", "a b c " * 100])
    want = t.words(column)
    monkeypatch.setattr(t, "SLICE_BYTES", 64)
    got = t.words(column)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    assert sum(s.num_rows for s in t.slices(iter([batch]), most=10)) == 5
    assert (np.concatenate([t.words(s.column("text"))[0] for s in t.slices(iter([batch]), most=10)]) == want[0]).all()


def test_grams_depend_on_order_and_words():
    hashes, _ = t.words(pa.array(["a b c a b c b a"]))
    g = t.grams(hashes, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 5
