"""All queries: edge tables, extra columns, and the pipeline against its stages."""

import os

import pytest

import __spark_entry__
import corpus_pipeline
from oracle_harness import compare, duck
from tagweave.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string",
    "embeddings": "vec_id long, embedding array<float>, label int", "pages": "page_id long, url string, html string"}
CLASH = ("key", "node", "component", "text_hash", "copy_id", "class_id", "kept", "score", "held_out", "n", "start", "file", "copy_no", "_gone", "vector",
         "band", "size", "template", "host", "path", "rule", "a.b", "leaf", "root", "_g", "_x", "base", "spans", "component")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Folders with empty tables, with null rows alone, and with columns of clashing names."""
    out = {}
    for kind in ("empty", "nulls", "clash"):
        out[kind] = str(tmp_path_factory.mktemp(kind))
        for name, schema in TABLES.items():
            df = spark.createDataFrame([] if kind == "empty" else [(None,) * len(schema.split(", "))] * 2, schema)
            if kind == "clash":
                df = spark.read.parquet(f"{SF}/{name}.parquet")
                df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in dict.fromkeys(CLASH) if c not in df.columns])
            df.write.parquet(os.path.join(out[kind], f"{name}.parquet"))
    return out

#: Sums of doubles, whose last digits follow the order of the rows.
ROUNDED = ("whitened", "explained", "identity_error")


def test_registered():
    assert len(QUERIES) == 14 and set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE) <= set(__spark_entry__.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix_sources", "token_shards"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_null_and_clashing_tables(spark, tables, name):
    query = QUERIES[name]
    assert query(spark, tables["empty"]).count() == 0
    nulls = query(spark, tables["nulls"]).count()
    assert nulls == 2 or name in ("op4_decontaminate", "op8_mix_sources", "op13_whitening", "pipeline")
    plain, clash = query(spark, SF), query(spark, tables["clash"])
    names = plain.columns
    assert set(names) <= set(clash.columns)
    key = lambda r: tuple(repr(x) for x in r)
    if name not in ("op1_toxicity", "pipeline"):
        rows = [sorted(map(key, df.select(*[c for c in names if c not in ROUNDED]).collect())) for df in (plain, clash)]
        assert rows[0] == rows[1]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    ok, _, _, _, detail = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert ok, detail


def test_stages_keep_columns_and_only_drop_or_repeat_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(text[r.doc_id] == r.text for r in rows)
        if name != "mix_sources":
            assert len({r.doc_id for r in rows}) == len(rows)
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [(5, "a b c d e f g h"), (2, "A b, c d e f g h"), (9, "x y z v w u"), (None, "a b c d e f g h"), (7, None)]],
                                 TABLES["documents"])
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [(False, 0), (True, 2), (True, 7), (True, 9)]
