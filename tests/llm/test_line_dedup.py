from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import line_dedup as m

from .cases import awkward, prose, rows, with_clashes

A, B, C, D = (f"{c} long line of text that is worth a cut when it comes again, number {c}" for c in "abcd")


def test_blocks_go_from_the_later_document(spark):
    df = rows(spark, ["\n".join([A, B, C]), "\n".join(["new one", A, "", B, "new two"]), "\n".join([C, "x", A]), D])
    got = {r.doc_id: r.text for r in m.without_repeated_lines(df).collect()}
    assert got[0] == "\n".join([A, B, C]) and got[3] == D
    assert got[1] == "new one\nnew two"
    # C and A cross: the patience diff keeps one of the two, which stays in order
    assert got[2] in ("\n".join(["x", A]), "\n".join([C, "x"]))


def test_short_blocks_and_single_frequent_lines_stay(spark):
    texts = [f"short\n{A}", *[f"short\nown {i} {C}" for i in range(5)]]
    got = {r.doc_id: r.text for r in m.without_repeated_lines(rows(spark, texts)).collect()}
    assert got == dict(enumerate(texts))
    few = {r.doc_id: r.text for r in m.without_repeated_lines(rows(spark, [f"{B}\nz {i}" for i in range(5)]), rare=3).collect()}
    assert all(few[i] == f"{B}\nz {i}" for i in range(5))  # one frequent line is no rare anchor


def test_a_long_line_is_cut_however_many_documents_have_it(spark):
    n = 60
    df = rows(spark, [A] * n + [f"{B}\nz {i}" for i in range(n)])
    got = {r.doc_id: r.text for r in m.without_repeated_lines(df).collect()}
    assert got[0] == A and all(got[i] == "" for i in range(1, n))
    assert got[n] == f"{B}\nz 0" and all(got[n + i] == f"z {i}" for i in range(1, n))


def test_a_block_is_cut_when_each_of_its_lines_is_older_elsewhere(spark):
    a, b, c, d = (f"{x} line of thirty characters {x}" for x in "abcd")
    texts = [a, b, c, d, "\n".join([a, b, "", c]), "\n".join(["own", a, b, c]), "\n".join([a, b, c, d]), "\n".join([d, a, b, c, d])]
    got = {r.doc_id: r.text for r in m.without_repeated_lines(rows(spark, texts)).collect()}
    assert [got[i] for i in range(5)] == texts[:5]
    assert (got[5], got[6], got[7]) == ("own", d, d)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=9), st.integers(1, 80))
def test_texts_share_a_run_when_they_share_a_block(a, b, least):
    size = {0: 7, 1: 25, 2: 33, 3: 61}

    def runs(text):
        row, keys, lines = m.run_keys(np.array(text, np.uint64), np.array([size[x] for x in text], np.int64), np.zeros(len(text), np.int64), least)
        return set(zip(keys.tolist(), lines.tolist(), strict=True))

    def blocks(text):
        return {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if sum(size[x] for x in text[i:j]) >= least}

    assert bool(runs(a) & runs(b)) == bool(blocks(a) & blocks(b))


def test_awkward_rows(spark):
    df = rows(spark, awkward())
    out = m.without_repeated_lines(with_clashes(df))
    assert out.columns == with_clashes(df).columns
    got = out.collect()
    assert len(got) == df.count()
    assert {r.doc_id for r in got} == {r.doc_id for r in df.collect()}
    assert sum(r.text is None for r in got) == 2
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
    assert m.without_repeated_lines(rows(spark, [])).collect() == []


def test_every_line_survives_somewhere(spark):
    import random

    r = random.Random(4)
    pool = [f"{i} " + "some line of moderate length to be shared around " * 2 for i in range(30)]
    df = rows(spark, ["\n".join(r.sample(pool, r.randrange(1, 12))) for _ in range(60)])
    before = {x for row in df.collect() for x in row.text.split("\n")}
    after = {x for row in m.without_repeated_lines(df).collect() for x in row.text.split("\n")}
    assert before <= after | {""}


lines = st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=14)


@settings(max_examples=200, deadline=None, derandomize=True)
@given(lines, lines)
def test_patience_matches_are_a_common_subsequence(a, b):
    found = m.patience_matches(a, b)
    assert all(a[i] is not None and a[i] == b[j] for i, j in found)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))


def test_patience_takes_the_longest_run_of_unique_lines():
    assert m.patience_matches([1, 2, 3, 4], [3, 1, 2, 4]) == [(0, 1), (1, 2), (3, 3)]


def test_white_space_around_lines_does_not_count(spark):
    block = [prose(70 + i, 12, 10**6) for i in range(3)]
    texts = ["\r\n".join(block), "\n".join(f"\t {x} \x0b" for x in block) + "\nan own line", "\n".join(block) + "\r"]
    got = {r.doc_id: r.text for r in m.without_repeated_lines(rows(spark, texts)).collect()}
    assert got[0] == texts[0] and got[1] == "an own line" and got[2] == ""
