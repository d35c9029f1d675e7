"""Every query of the text operators against its SQL, and the pipeline's stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from seriesloom.llm import registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    frame = registry.QUERIES[name](spark, SF_DIR)
    rows = frame.collect()
    assert rows
    if name not in registry.ORACLES:
        return
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    relation = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(tuple(row[n] for n in names) for row in rows) == sorted(relation.fetchall())


LEARNED_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")

#: crc32 of a decimal id, by its polynomial division bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: CAST(ascii(c) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
  lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def frame_of(spark, name, folder=LEARNED_DIR):
    """A query's rows beside the documents and labels of the same folder."""
    frame = registry.QUERIES[name](spark, folder).toPandas()
    docs = duckdb.sql(f"SELECT doc_id, lang, {CRC} AS crc FROM '{folder}/documents.parquet'").df()
    labels = duckdb.sql(f"SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM '{folder}/labels.parquet' GROUP BY 1").df()
    return frame.merge(docs, on="doc_id").merge(labels, on="doc_id", how="left")


def area(scores, marks):
    """Chance that a marked row scores higher than another one."""
    ranks = scores.rank()
    positive = int(marks.sum())
    return (ranks[marks].sum() - positive * (positive + 1) / 2) / (positive * (len(marks) - positive))


def test_language_of_held_out_documents(spark):
    rows = frame_of(spark, "op5_language_id")
    assert (rows.held_out == (rows.crc % 3 == 1)).all()
    judged = rows[rows.held_out & rows.lang.notna() & (rows.lang_pred != "und")]
    assert len(judged) > 200 and (judged.lang_pred == judged.lang).mean() > 0.97


def test_toxicity_of_held_out_documents(spark):
    rows = frame_of(spark, "op1_toxicity", os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.1"))  # enough labels to learn from
    assert (rows.held_out == (rows.crc % 4 == 2)).all() and (rows.predicted == (rows.score >= 0.3)).all()
    judged = rows[rows.held_out & rows.toxic.notna()]
    found = judged[judged.toxic == 1].predicted
    assert len(found) >= 8 and found.mean() >= 0.85 and judged[judged.toxic == 0].predicted.mean() <= 0.02


def test_quality_scores_order_good_before_bad(spark):
    rows = frame_of(spark, "op6_quality_classifier")
    judged = rows[rows.quality.notna()]
    assert area(judged.score, judged.quality == 1) > 0.95


def test_base_columns_of_the_language_model(spark):
    """Counts and the add-one score of words, recomputed in SQL."""
    got = registry.QUERIES["op8_lattice_lm_scoring"](spark, LEARNED_DIR).toPandas().set_index("doc_id")
    want = duckdb.sql(f"""
WITH docs AS (
  SELECT doc_id, {CRC} % 7 = 2 AS held_out, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' end') AS w FROM '{LEARNED_DIR}/documents.parquet'),
tokens AS (SELECT doc_id, held_out, unnest(w) AS t FROM docs),
counts AS (SELECT t, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY 1),
sizes AS (SELECT sum(c) AS n, count(*) AS v FROM counts)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens,
       sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score
FROM tokens LEFT JOIN counts USING (t), sizes GROUP BY 1, 2""").df().set_index("doc_id").loc[got.index]
    for column in ("held_out", "n_tokens", "n_known", "train_tokens"):
        assert (got[column] == want[column].astype(got[column].dtype)).all(), column
    assert ((got.base_score - want.base_score).abs() <= 1e-9 * want.base_score.abs() + 1e-9).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() > 0


def test_pipeline_stages_on_empty_and_odd_rows(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    long = " ".join(f"word{k % 977}" for k in range(30_000))
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (4, long, "en", "s", len(long)),
           (4, long, "en", "s", len(long)), (None, "no id here", None, "s", 10), (5, "é" * 60, "fr", "s", 60)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR).cache()
            assert docs.columns == schema.names
        ids = sorted((row.doc_id is None, row.doc_id or 0) for row in docs.collect())
        assert ids == ([] if not rows else [(False, 1), (False, 2), (False, 3), (False, 5), (True, 0)])
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert packed.filter("start = 0").count() == len(ids)
