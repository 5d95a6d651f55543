from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm.tables import components, drop_stored, stored

from .cases import awkward, edited, prose, rows, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(rows(spark, awkward(), start=10_000))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF)))
    return out


def test_the_number_of_languages_does_not_drop_texts(spark):
    df = rows(spark, ["the same words in every language"] * 48 + ["12 34"])
    df = df.withColumn("lang", F.concat(F.lit("l"), (F.col("doc_id") % 6).cast("string")))
    assert ids(corpus_pipeline.known_language(spark, df, SF)) == sorted(str(i) for i in range(48))


def test_languages_are_learned_from_all_labelled_rows(spark):
    """The labelled rows are of the fold that op9 holds out, or have no doc_id."""
    fold = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2][:4]
    others = rows(spark, [(i, "other words of text") for i in range(100, 110)]).withColumn("lang", F.lit(None).cast("string"))
    for labelled in (fold, [None]):
        df = others.unionByName(rows(spark, [(i, "some words of text") for i in labelled]))
        assert corpus_pipeline.known_language(spark, df, SF).count() == df.count()


def ids(df):
    return sorted(str(r.doc_id) for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert stages[-1].columns == [*stages[0].columns, "mix_position", "mix_epoch"]


def test_language_stage_drops_texts_without_letters(stages):
    lost = stages[0].select("doc_id", "text").exceptAll(stages[1].select("doc_id", "text")).collect()
    assert all(not any(c.isalpha() for c in r.text or "") for r in lost) and len(lost) == 4


def test_line_stage_keeps_first_copies(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: r.text for r in stages[2].collect()}
    gone = set(before) - set(after)
    lines = {x.strip() for t in after.values() for x in t.split("\n")}
    assert all(x.strip() in lines for d in gone for x in before[d].split("\n") if len(x.strip()) > 60)


def test_near_copies_and_contaminated_documents_go(spark, stages):
    bench = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    third = [(r.doc_id, shingles(r.text)) for r in stages[3].collect() if r.doc_id is not None]
    for i, (_, x) in enumerate(third):
        assert not any(x and 5 * len(x & y) >= 4 * len(x | y) for _, y in third[:i])
    kept = {r.doc_id for r in stages[4].collect()}
    assert kept >= {d for d, x in third if not any(len(x & b) >= 0.8 * len(b) for b in bench)}
    assert not any(d in kept and any(len(x & b) >= 0.8 * len(b) for b in bench) for d, x in third)


def test_no_near_copy_stays_in_parts(spark, workdir):
    """Copies with words changed on some of their lines: the line stage cuts the equal lines, the join stage must know the whole texts."""
    import random

    r = random.Random(3)
    texts, copies = [], set()
    for group in range(6):
        lines = [prose(100 * group + i, 14, 10**6) for i in range(12)]
        texts.append("\n".join(lines))
        for k in range(3):
            other = list(lines)
            for at in r.sample(range(12), 1 + k % 2):
                other[at] = edited(other[at], 1000 * group + 10 * at + k, 1)
            copies.add(len(texts))
            texts.append("\n".join(other))
    # half of another text and half of its own: no near copy, its own half stays
    texts.append("\n".join(texts[0].split("\n")[:6] + [prose(9000 + i, 14, 10**6) for i in range(6)]))
    own = {i: t for i, t in enumerate(texts)}
    rows(spark, texts).write.parquet(f"{workdir}/documents.parquet")
    docs = spark.read.parquet(f"{workdir}/documents.parquet")
    cut = stored(corpus_pipeline.fresh_lines(spark, docs, workdir))
    kept = {x.doc_id: x.text for x in corpus_pipeline.one_of_each_group(spark, cut, workdir).collect()}
    assert copies & {x.doc_id for x in cut.select("doc_id").collect()}, "the line stage left parts of copies"
    assert set(kept) == set(own) - copies
    assert kept[len(texts) - 1] == "\n".join(texts[-1].split("\n")[6:])


def test_whole_texts_of_other_documents_are_not_taken(spark, workdir):
    """A stage that is given documents of its own under ids that the folder uses for other texts goes by the documents alone."""
    same = prose(1, 200)
    rows(spark, [same, same, same]).write.parquet(f"{workdir}/documents.parquet")
    mine = rows(spark, [prose(50 + i, 100, 10**6) for i in range(3)])
    assert corpus_pipeline.one_of_each_group(spark, mine, workdir).count() == 3


def test_every_kept_document_is_in_the_mix(stages):
    assert ids(stages[5].filter("mix_epoch = 0")) == ids(stages[4])


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.select(F.max("mix_position") + 1, F.count("*")).first()[0] == got.count()


def test_empty_tables(spark):
    docs = rows(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_components_of_long_paths_stars_and_nulls(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(500, 600)] + [(None, 3), (7, 7), (600, 500), (9, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, **{k: 1 for k in range(500, 601)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stored_tables_can_be_dropped(spark):
    df = stored(spark.range(5))
    assert df.count() == 5
    drop_stored(spark)
