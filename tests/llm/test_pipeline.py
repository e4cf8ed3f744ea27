"""Each stage against plain Python on its own input, and the query counterparts in SQL."""

import duckdb
import pytest

import corpus_pipeline
from lakeweave.llm import langid, oracle, queries

from test_lines_and_passages import brute_lines
from test_oracle import TABLES, table
from test_simhash import expected
from test_tokens_and_packing import check_packing

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_counterpart(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck.execute(oracle.ORACLE[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([c[0] for c in result.description], result.fetchall())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    folder, docs, found = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = (before, docs.collect(), docs.columns)
    return found


def test_stages_keep_the_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    for name in list(stages)[:-1]:
        assert stages[name][2] == COLUMNS


def test_language_stage(spark, stages):
    before, after, _ = stages["language_id"]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    accepted = {r.doc_id for r in langid.predict(docs, langid.train(docs)).where("accepted").collect()}
    assert sorted(r.doc_id for r in after) == sorted(accepted)
    assert len(after) >= 0.97 * len(before)


def test_line_stage(stages):
    before, after, _ = stages["line_dedup"]
    want = brute_lines([(r.doc_id, r.text) for r in before], 8)
    assert sorted(((r.doc_id, r.text) for r in after), key=repr) == sorted(((d, t) for d, _, _, t in want), key=repr)


def test_simhash_stage(stages):
    before, after, _ = stages["simhash_dedup"]
    want = {c for _, _, c in expected([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id for r in after} == want and len(after) == len(want)


def test_mix_stage(stages):
    before, after, _ = stages["source_mix"]
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in before}
    taken = {}
    for r in after:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(r.text.encode().split())
    assert all(n <= 2 * sizes[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 128 * 25


def test_packing_stage(stages):
    before, after, _ = stages["mixture_packing"]
    check_packing([tuple(r) for r in before], after)


def test_run(spark, stages):
    """The whole pipeline packs the ids that its stages pack; queues follow the files of the stage before, so places may differ."""

    def ids_per_document(rows):
        found = {}
        for r in rows:
            found[r.doc_id, r.doc_tokens] = found.get((r.doc_id, r.doc_tokens), 0) + r.length
        return found

    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert ids_per_document(got) == ids_per_document(stages["mixture_packing"][1])


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_stages_take_odd_rows_and_empty_tables(spark, documents, odd_rows, tmp_path, kind):
    docs = documents(odd_rows if kind == "odd" else [])
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "mixture_packing":
            assert docs.columns == columns
    rows = [(r.doc_id, r.text) for r in before.collect()]
    check_packing(rows, docs.collect())
    assert bool(rows) == (kind == "odd")
