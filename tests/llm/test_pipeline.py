from collections import Counter

import corpus_pipeline
from wardline.llm import op3_minhash_dedup, op4_language_id, queries
from wardline.storage import file_system, scratch_folder

from .conftest import odd_rows, prose
from .test_op2_decontamination import plain as plain_leaks
from .test_op3_minhash import plain as plain_groups
from .test_op1_op6_tokens import _index, _plain

SF = "/root/testdata/sf0.001"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "source_mix", "token_shards"]


def test_each_stage_against_plain_python(spark):
    docs = queries.documents(spark, SF)
    items = [tuple(r) for r in queries.table(spark, SF, "benchmark").select("item_id", "text").collect()]
    before = {r.doc_id: r for r in docs.collect()}

    known = stage("language_id")(spark, docs, SF)
    assert known.schema == docs.schema
    rows = known.collect()
    assert {tuple(r) for r in rows} <= {tuple(r) for r in before.values()}
    assert len(rows) > 0.95 * len(before)
    assert not [r for r in rows if not op4_language_id.has_letter(r.text)]

    known = known.cache()
    single = stage("near_dedup")(spark, known, SF)
    keep = {g[0] for g in plain_groups([(r.doc_id, r.text) for r in rows], 5, 80) if g[3]}
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == keep

    clean = stage("decontamination")(spark, single, SF)
    leaked = {x[0] for x in plain_leaks([(i, before[i].text) for i in keep], items)}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == keep - leaked and leaked

    mixed = stage("source_mix")(spark, clean, SF)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and set(copies) <= keep - leaked and max(copies.values()) <= 3

    packed = stage("token_shards")(spark, mixed, SF).collect()
    want = _index([(r.doc_id, r.text) for r in mixed.collect()])
    assert _plain(packed) == want


def test_a_run_leaves_its_result_and_the_token_files(spark):
    files, where = file_system(spark, scratch_folder(spark))

    def folders():
        return {f.getPath().getName() for f in files.listStatus(where)} if files.exists(where) else set()

    before = folders()
    out = corpus_pipeline.run(spark, SF)
    assert {name.split("-")[0] for name in folders() - before} == {"token_shards", "tokens"} and out.count() > 20


def test_run_and_odd_rows(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 20
    rows = [*odd_rows(2000), *[(100 + k, prose(k, 40), "en", "a") for k in range(40)]]
    found = docs(rows, clashing=True)
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, found, SF)
        assert after.columns == found.columns, name
        found = after
    assert corpus_pipeline.STAGES[-1][1](spark, found, SF).count() == found.count()


def test_empty_table_passes_through(spark, docs):
    found = docs([])
    for _, step in corpus_pipeline.STAGES:
        found = step(spark, found, SF)
        assert found.collect() == []


def test_repeated_rows_are_one_document(spark, docs):
    rows = [(1, prose(1, 50)), (1, prose(1, 50)), (2, prose(2, 50))]
    assert sorted(r.doc_id for r in op3_minhash_dedup.without_near_duplicates(docs(rows)).collect()) == [1, 2]
