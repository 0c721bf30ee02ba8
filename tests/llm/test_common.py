import pyarrow as pa

from chainlake.llm import common


def test_scratch_tables_are_swept(spark):
    table = common.saved(spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS none"), "t")
    empty = common.saved(spark.range(0), "e")
    assert table.count() == 5 and empty.count() == 0 and empty.columns == ["id"]
    path = common._written[spark.sparkContext.applicationId][-1]
    fs, p = common.filesystem(spark, path)
    assert fs.exists(p) and common.sweep(spark) >= 2 and not fs.exists(p)
    assert common.sweep(spark) == 0


def test_slices():
    batch = pa.RecordBatch.from_pydict({"a": list(range(10))})
    assert [b.num_rows for b in common.slices(iter([batch, batch.slice(0, 0)]), 4)] == [4, 4, 2]
    batch = pa.RecordBatch.from_pydict({"t": ["x" * (2000 if i == 3 else 10) for i in range(10)], "i": list(range(10))})
    cut = list(common.slices(iter([batch]), 8, 500))
    assert [r for b in cut for r in b.column("i").to_pylist()] == list(range(10)) and [b.num_rows for b in cut if b.nbytes > 500] == [1] and len(cut) < 6


def test_rows_are_split_by_keys(spark, monkeypatch):
    """All rows that have a key are in the first part, few others are, and none is lost; null keys are values like others."""
    rows = spark.range(20000).selectExpr("IF(id % 100 = 7, NULL, id) AS id", "id % 3 AS raw", "'x' AS piece", "id AS Bitmap")
    keys = rows.where("id % 20 = 0 OR id IS NULL").select("id", "raw").distinct()
    want = {tuple(r) for r in keys.collect()}
    for bits in (common.MOST_BITS, common.PIECE):
        monkeypatch.setattr(common, "MOST_BITS", bits)
        may, rest = common.split_by(rows, keys, ["id", "raw"])
        may, rest = may.collect(), rest.collect()
        assert len(may) + len(rest) == 20000 and may[0].asDict().keys() == rest[0].asDict().keys() == {"id", "raw", "piece", "Bitmap"}
        assert not any((r.id, r.raw) in want for r in rest) and len(may) < 2000
    may, rest = common.split_by(rows, keys.limit(0), ["id", "raw"])
    assert may.count() == 0 and rest.count() == 20000 and common.split_by(rows.limit(0), keys, ["id", "raw"])[0].count() == 0


def test_unused_names():
    assert common.unused(["a", "B", "b_"], "b", "a", "c", "c") == ["b__", "a_", "c", "c_"]


def test_entry_lists_every_query():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names) and set(entry.core.QUERIES) <= set(entry.oracle_sql())
