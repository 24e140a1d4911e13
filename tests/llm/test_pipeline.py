import os

import corpus_pipeline as p

from .conftest import DATA
from .test_decontamination import brute as leaks
from .test_simhash import brute as groups


def test_stages(spark, documents, rows):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    known = p.identified(spark, documents, DATA)
    assert known.columns == documents.columns
    ids = {r.doc_id for r in known.collect()}
    assert len(ids) > 0.99 * len(rows)
    some = [r for r in rows if r[0] in ids]
    first = {c for _, _, c in groups(some)}
    deduplicated = p.deduplicated(spark, known, DATA)
    assert deduplicated.columns == documents.columns and {r.doc_id for r in deduplicated.collect()} == first
    some = [r for r in some if r[0] in first]
    clean = p.decontaminated(spark, deduplicated, DATA)
    left = first - {d for d, *_ in leaks(some, items)}
    assert clean.columns == documents.columns and {r.doc_id for r in clean.collect()} == left
    mixed = p.mixed(spark, clean, DATA)
    assert mixed.columns == documents.columns and {r.doc_id for r in mixed.collect()} == left
    assert {r.doc_id for r in p.run(spark, DATA).collect()} == left


def test_the_store_follows_the_mix(spark, documents, tmp_path):
    from pitchline.llm import mixing

    p.mixed(spark, documents, DATA).write.parquet(f"{tmp_path}/mixed")
    stored = p.stored(spark, spark.read.parquet(f"{tmp_path}/mixed"), DATA).orderBy("start").collect()
    made = mixing.mix(documents).orderBy("slot", "place").select("doc_id").collect()
    assert [r.doc_id for r in stored] == [r.doc_id for r in made]


def test_odd_tables(spark, odd, empty, tmp_path):
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = odd.withColumnsRenamed({"kind": "__part", "slot": "__file", "row": "__row", "h": "__digest", "value": "__text", "n_words": "whole"})
    for table in (odd, empty, own):
        docs = table
        for _, stage in p.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == table.columns
        assert p.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    assert os.path.exists(tmp_path)


def test_rows_that_share_an_id_are_judged_by_their_texts(spark, rows, tmp_path):
    first = {c for *_, c in groups(rows)}
    different = [t for d, t, *_ in rows if d in first and t and len(t.split()) > 30][:60]
    given = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, t, "en", "s") for i, t in enumerate(different)]
    # the first row by id of a group shares its id with a row of another group; equal rows; null and empty texts
    given += [(7, different[0], "en", "s"), (None, different[1], "en", "s"), (7, different[1], "fr", "s"), (None, None, "en", "s"), (None, "", "en", "s")]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string, source string")
    kept = [(r.doc_id, r.text) for r in p.deduplicated(spark, df, DATA).collect()]
    assert sorted(t or "" for _, t in kept) == sorted([*different, ""])
    assert (7, different[0]) in kept and (None, different[0]) not in kept  # null comes last
    item = " ".join(different[5].split()[:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    bad = {d for d, *_ in leaks([(i, t, "en", "s") for i, (_, t, *_) in enumerate(given)], [(1, item)])}
    clean = [(r.doc_id, r.text) for r in p.decontaminated(spark, df, str(tmp_path)).collect()]
    assert bad and sorted(map(str, clean)) == sorted(str(r[:2]) for i, r in enumerate(given) if i not in bad)
