from __future__ import annotations

import random

from kerbside.llm import decontaminate as m

from .cases import awkward, edited, prose, rows, shingles, with_clashes


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def brute(df, bench) -> dict:
    out: dict = {}
    for b in bench.collect():
        own = shingles(b.text) if len((b.text or "").split()) >= 5 else frozenset()
        for d in df.collect():
            if own and d.doc_id is not None:
                share = len(own & shingles(d.text)) / len(own)
                if share >= 0.8:
                    out[d.doc_id, b.item_id] = max(share, out.get((d.doc_id, b.item_id), 0))
    return out


def test_equals_brute_force(spark):
    r = random.Random(6)
    tests = [prose(s, n) for s, n in enumerate((5, 6, 9, 14, 20, 33, 50, 80, 130, 300))]
    texts = [prose(100 + i, r.randrange(1, 900)) for i in range(20)]
    for k, t in enumerate(tests):
        host = prose(200 + k, 1500).split()
        at = r.randrange(len(host))
        texts += [" ".join([*host[:at], edited(t, k, e), *host[at:]]) for e in (0, 1, 3)] + [t, " ".join(t.split()[: max(5, int(0.9 * len(t.split())))])]
    df, bench = rows(spark, texts), items(spark, [*tests, None, "", "too short here", tests[3]])
    got = {(x.doc_id, x.item_id): x.containment for x in m.contaminated(with_clashes(df), bench).collect()}
    assert got == brute(df, bench) and len(got) > 30


def test_an_item_spread_over_a_long_document_is_found(spark):
    item = prose(1, 100, 10**6).split()
    spread = " ".join([*item[:50], *prose(2, 400, 10**6).split(), *item[50:]])
    third = " ".join(" ".join([*item[k : k + 25], *prose(3 + k, 300, 10**6).split()]) for k in (0, 25, 50, 75))
    df, bench = rows(spark, [spread, third, prose(9, 700, 10**6)]), items(spark, [" ".join(item), prose(5, 30, 10**6)])
    got = {(x.doc_id, x.item_id): x.containment for x in m.contaminated(df, bench).collect()}
    assert got == brute(df, bench) and got[0, 0] == 92 / 96


def test_awkward_rows_and_empty_tables(spark):
    df, bench = rows(spark, awkward()), items(spark, [prose(1, 80), prose(3, 40)])
    got = {(x.doc_id, x.item_id): x.containment for x in m.contaminated(with_clashes(df), bench).collect()}
    assert got == brute(df, bench) and {d for d, _ in got} >= {5, 6, 7, 10}
    assert m.contaminated(rows(spark, []), bench).collect() == []
    assert m.contaminated(df, items(spark, []).filter("item_id < 0")).collect() == []


def test_only_contaminated_rows_go(spark):
    df = with_clashes(rows(spark, [prose(1, 60), prose(2, 60), None, "", (None, prose(1, 60))]))
    kept = m.without_contaminated(df, items(spark, [prose(1, 50)]))
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "None"]


def test_partitions_cover_all_sizes():
    for n in range(1, 3000):
        p = m.partition_of(n)
        assert n <= m.largest(p) and (p == 0 or n > m.largest(p - 1))


def test_minhash_alone_finds_items_inside_a_window(spark, monkeypatch):
    """At containment from 0.8 on, without the join of rarest shingles; and without MinHash nothing inside a window is found."""
    r = random.Random(8)
    tests, texts, want = [], [], set()
    for k in range(150):
        item = prose(3000 + k, r.randrange(12, 120), 10**6).split()
        tests.append(" ".join(item))
        copy = list(item)
        while True:  # change words while four fifths of the shingles are left
            more = list(copy)
            more[r.randrange(len(more))] = f"x{r.random()}"
            if len(shingles(" ".join(more)) & shingles(tests[-1])) < 0.8 * len(shingles(tests[-1])) or r.random() < 0.3:
                break
            copy = more
        host = prose(5000 + k, 400, 10**6).split()
        at = r.randrange(len(host))
        texts.append(" ".join([*host[:at], *copy, *host[at:]]))
        want.add((k, k))
    df, bench = rows(spark, texts), items(spark, tests)
    monkeypatch.setattr(m, "_by_rare_shingles", lambda hits, items: hits.select("row", m.F.lit(0).cast("long").alias("item_id")).limit(0))
    got = {(x.doc_id, x.item_id) for x in m.contaminated(df, bench).collect()}
    assert got <= want and len(got) >= 0.99 * len(want)
    monkeypatch.undo()
    monkeypatch.setattr(m, "holds", lambda packed, values, bits: m.np.zeros(len(values), bool) if len(values) == m.PERMUTATIONS else HOLDS(packed, values, bits))
    assert m.contaminated(df, bench).count() == 0


HOLDS = m.holds
