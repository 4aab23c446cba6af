"""The pipeline: every stage against its operator's own definition, and the SQL of registered queries."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from cityflow.llm.queries import ORACLES, QUERIES
from helpers import CLASHING, DOCUMENTS, EDGES, clashing, stored
from test_classifiers import corpus
from test_simhash import fingerprint, near, roots


def lower(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("schema", [DOCUMENTS, CLASHING])
def test_stages_on_planted_rows(spark, tmp_path, schema):
    plain = [(1000 + i, t, "en", f"s{i % 3}", len(t)) for i, t, _, _ in corpus(300)]
    copies = [(2000 + i, t.upper() if i % 5 == 0 and "!!" not in t else t, a, b, n) for i, (_, t, a, b, n) in enumerate(plain[:60])]
    rows = EDGES + plain + copies
    toxic = {1000 + i: x for i, _, x, _ in corpus(300)} | {2000 + i: x for i, _, x, _ in corpus(60)}
    quality = {1000 + i: q for i, _, _, q in corpus(300)}
    folder = tmp_path / "tables"
    spark.createDataFrame([(i, quality[i], toxic[i]) for i in quality], "doc_id bigint, quality int, toxic int").write.parquet(
        str(folder / "labels.parquet")
    )
    docs = stored(spark, tmp_path, clashing(rows) if schema == CLASHING else rows, schema)
    texts, seen = {}, [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, str(folder)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs)
    given, clean, good, single, apart, packed = ([tuple(r) for r in d.collect()] for d in seen)
    for before, after in zip(seen[:4], seen[1:5]):
        assert after.columns == before.columns
        assert set(map(str, after.collect())) <= set(map(str, before.collect()))
    assert {r[0] for r in given} - {r[0] for r in clean} == {i for i, x in toxic.items() if x}
    gone = {r[0] for r in clean} - {r[0] for r in good}
    assert {i for i in gone if i in quality} == {i for i, q in quality.items() if not q and not toxic[i]}
    texts = {}
    for r in good:
        texts.setdefault(lower(r[1]), []).append(r[0])
    assert sorted(str(r[0]) for r in single) == sorted(
        str(max((x for x in ids if x is not None), default=None)) for ids in texts.values()
    )
    prints = sorted({fingerprint(r[1]) for r in single})
    root = roots(near(prints), prints)
    low = {}
    for r in single:
        low.setdefault(root[fingerprint(r[1])], []).append(r[0])
    assert sorted(str(r[0]) for r in apart) == sorted(
        str(min((x for x in ids if x is not None), default=None)) for ids in low.values()
    )
    assert {r[0] for r in packed} == {r[0] for r in apart}


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_applies_the_stages(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert 0 < found.select("doc_id").distinct().count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_everything_is_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = con.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    found = QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in found.select(columns).collect()))) == sorted(map(str, wanted.fetchall()))
