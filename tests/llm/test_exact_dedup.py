import hashlib
import re

from rankforge.llm.exact_dedup import drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, keep_id string, n long"
ROWS = [(5, "a b", "x", 1), (3, "ab", "x", 1), (9, "a\tb \n", "x", 1), (4, None, None, 1), (7, "", "x", None),
        (1, " ", "x", 1), (2, "a b" * 9000, "x", 1), (8, "ab" * 9000, "x", 1), (6, "ä b", "x", 1),
        (10, "äb", "x", 1), (11, "c", "x", 1), (11, "c", "x", 1), (None, "d", "x", 1), (12, " ", "x", 1)]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    out = []
    for i, r in enumerate(rows):
        same = [j for j, x in enumerate(rows) if norm(x[1]) == norm(r[1])]
        keep = min(same, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0, j))
        out.append((r[0], rows[keep][0], len(same), keep == i, hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for fan_in, runs in ((2, 8), (4, 16), (3, 1)):
        got = sorted((tuple(r) for r in exact_dedup(df, fan_in=fan_in, runs=runs).collect()), key=str)
        assert got == brute(ROWS)


def test_hot_group_and_empty(spark):
    df = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) text")
    got = exact_dedup(df, runs=16).where("group_size > 1").collect()
    assert len(got) == 1000 and {r.keep_id for r in got} == {0} and sum(r.kept for r in got) == 1
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_keeps_columns(spark):
    df = spark.createDataFrame([r for r in ROWS if r[0] != 11], SCHEMA)
    got = drop_copies(df)
    assert got.columns == df.columns
    assert {r.doc_id for r in got.collect()} == {9, 1, 2, 6, None, 12, 11} - {11}


def test_native_plan(spark):
    df = exact_dedup(spark.createDataFrame(ROWS, SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_drop_goes_by_row(spark, tmp_path):
    rows = [(5, "aaa"), (5, "bbb"), (3, "bbb"), (11, "c"), (11, "c"), (None, "d"), (None, "d"), (None, "e"), (7, None), (7, "")]
    want = sorted([(5, "aaa"), (3, "bbb"), (11, "c"), (None, "d"), (None, "e")], key=str)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df.write.parquet(str(tmp_path / "docs"))
    for docs in (df, spark.read.parquet(str(tmp_path / "docs"))):
        got = sorted((tuple(r) for r in drop_copies(docs).collect() if r.text), key=str)
        assert got == want
        assert drop_copies(docs).count() == len(want) + 1                   # one of the empty texts


def test_one_row_of_a_group_is_kept(spark):
    rows = [(7, "a b c", "", 0), (7, "abc", "", 0), (8, "abc", "", 0), (None, "x", "", 0), (None, "x", "", 0)]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in got if r.kept) == [(0, None, 2), (7, 7, 3)]


def test_drops_hold_when_files_are_split_anew(spark, tmp_path):
    """The rows that go are named by file and place, not by how a read deals them."""
    from rankforge.llm.jaccard_join import drop_near_copies
    rows = [(i % 600, "text %d " % (i % 600) + "of some words that differ by number %d" % (i % 600 * 7919)) for i in range(1200)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(path)
    for drop, want in ((drop_copies, 600), (drop_near_copies, 600)):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            left = drop(spark.read.parquet(path))                        # decided here
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert left.count() == want and left.distinct().count() == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 5, 6, 7), (2, "a", 8, 9, 10)], "doc_id long, text string, __row int, row int, id int")
    got = drop_copies(df)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(1, "a", 5, 6, 7)]
