import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import frame, row, sentences
from chainlake.llm import common, decontam, linedup, neardup, packing
from test_line_dedup import brute, clean
from test_near_duplicates import brute_classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = common.read(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = common.saved(stage(spark, docs, SF), name)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()]


def test_stages(outputs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "line_dedup", "near_duplicates", "decontaminate", "packing"]
    source = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet'")
    assert all(outputs[n].columns == source.columns for n in names[:-1])
    before = {d: t for d, t in texts(outputs["language"])}
    assert before == {r[0]: r[1] for r in source.fetchall()}  # every text here has a language
    want = {d: ls for d, ls in brute(texts(outputs["language"])).items() if ls or not clean(before[d])}
    assert {d: clean(t) for d, t in texts(outputs["line_dedup"])} == want
    assert all(r.n_chars == len(r.text) for r in outputs["line_dedup"].collect() if r.text != before[r.doc_id])
    index = decontam.Index(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
    assert texts(outputs["decontaminate"]) == [(d, t) for d, t in texts(outputs["near_duplicates"]) if not index.matches(t)]
    encode = packing.Encoder(*packing.default_paths())
    assert outputs["packing"].agg({"length": "sum"}).first()[0] == sum(len(encode(t)) for _, t in texts(outputs["decontaminate"]))


def test_near_duplicates_keep_one_of_each_class(spark, outputs):
    before = outputs["line_dedup"]
    found = neardup.near_duplicates(before).collect()
    assert {d for d, _ in texts(outputs["near_duplicates"])} == {r.doc_id for r in found if r.kept}
    classes = brute_classes(texts(before), neardup.inverse_frequencies(before))
    kept = {d for d, _ in texts(outputs["near_duplicates"])}
    assert all(len(c & kept) == 1 and min(c) in kept for c in classes)


def test_run_is_its_stages(spark, outputs):
    """The rows of run() are those that the stages give one after the other, and what it wrote in between is gone but for its last input."""
    before = common.scratch_tables(spark)
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == outputs["packing"].columns
    left = [p for p in common.scratch_tables(spark) if p not in before]
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left] == [f"stage-{n}" for n, _ in corpus_pipeline.STAGES[:-1]]
    pieces = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    of = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.where("start = 0").collect())
    assert of(found) == of(outputs["packing"]) and len(of(found)) == len(texts(outputs["decontaminate"]))
    encode = packing.Encoder(*packing.default_paths())
    tokens = {d: encode(t) for d, t in texts(outputs["decontaminate"])}
    for table in (found, outputs["packing"]):
        assert all(crc == zlib.crc32(tokens[d][start : start + n].astype("<u4").tobytes()) and total == len(tokens[d]) for d, start, n, crc, total in pieces(table))


def test_language_rejects(spark):
    """Texts in a language that no label teaches, junk of letters and texts without letters go; those of taught languages stay, short ones too."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(800).cache()
    rng, top = random.Random(2), docs.agg({"doc_id": "max"}).first()[0]
    other = "wszystkich którzy przyszli dziś wieczorem żeby obejrzeć nowe przedstawienie proszę ażeby zajęli miejsca ponieważ zaczynamy już wkrótce " * 6
    junk = " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(120))
    bad = [(top + 1 + i, t, None, "s", len(t)) for i, t in enumerate([other, junk, "12 345 !?", "", "где эта улица где этот дом " * 9])] + [(top + 9, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    both = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")).unionByName(spark.createDataFrame(bad, schema))
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, both, SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}


def test_clashing_columns_keep_their_values(spark):
    """Columns named like those that the operators add for themselves."""
    rng = random.Random(3)
    lines = sentences(rng, 30)
    names = ["deleted", "id", "raw", "runs", "new", "found", "bucket", "node", "n", "Deleted_"]
    rows = [(i, "\n".join([*lines[:10], *sentences(rng, 8)]), "en", *[f"keep {k} {i}" for k in range(len(names))]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, SF), "stage")
        assert docs.columns == ["doc_id", "text", "lang", *names] and docs.count() > 0
        assert all(tuple(r)[3:] == tuple(f"keep {k} {r.doc_id}" for k in range(len(names))) for r in docs.collect())
    found = linedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in names)))
    assert found.columns[-1] == "deleted__" and found.agg({"deleted__": "sum"}).first()[0] > 0


def test_awkward_rows_and_empty_tables(spark):
    rng = random.Random(1)
    for rows in ([row(i, " ".join(sentences(rng, 3))) for i in range(20)] + [row(None, None, None), row(3, ""), row(30, "x\n" * 100)], []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = common.saved(stage(spark, docs, SF), "stage")
            assert set(out.columns) <= set(docs.columns)
            docs = out
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0) == bool(rows)
