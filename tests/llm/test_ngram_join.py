from __future__ import annotations

from kerbside.llm import ngram_join as m

from .cases import awkward, edited, prose, rows, shingles, with_clashes


def brute(data: list) -> dict:
    """Components by comparing every pair; rows that repeat a doc_id are one node."""
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in data if d is not None]
    for d, _ in sets:
        find(d)
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {d: find(d) for d, _ in sets}


def check(spark, data: list, **columns):
    df = rows(spark, data)
    got = m.ngram_jaccard_components(with_clashes(df)).collect()
    pairs = [(r.doc_id, r.text) for r in df.collect()]
    want = brute(pairs)
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted(
        (str(d), len(shingles(t)), want.get(d)) for d, t in pairs
    )


def test_awkward_rows(spark):
    check(spark, awkward())


def test_empty_table(spark):
    assert m.ngram_jaccard_components(rows(spark, [])).collect() == []


def test_light_and_heavy_groups_equal_brute_force(spark):
    data = []
    for size in (4, 6, 9, 12, 14, 15, 18, 30, 60, 150, 400):
        base = prose(size, size)
        data += [base, *[edited(base, 10 * size + k, 1 + k % 4) for k in range(8)], " ".join(base.split()[: size - size // 8]), base + " tail words here"]
    check(spark, data)


def test_each_boundary_gives_the_same_links(spark, monkeypatch):
    data = [edited(prose(s, n), k, k) for s, n in enumerate((8, 12, 20, 40)) for k in range(5)]
    for x in (4, 9, 16, 256):
        monkeypatch.setattr(m, "boundary", lambda stats, x=x: x)
        check(spark, data)


def test_borderline_group_of_near_copies(spark):
    base = prose(5, 150)
    check(spark, [edited(base, k, k % 6) for k in range(120)])


def test_one_of_each_group_stays(spark):
    base = prose(9, 50)
    df = rows(spark, [base, base, edited(base, 1, 1), prose(10, 50), "", None, (0, base), (None, base)])
    kept = m.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "3", "4", "5", "None"]


def test_boundary_is_the_cheapest():
    assert m.boundary([(10, 5, 500.0, 5), (100, 100_000, 300.0, 50)]) in range(11, 101)
    assert m.boundary([]) == 4
