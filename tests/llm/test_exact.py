import hashlib

from pyspark.sql import functions as F

from sitepulse.llm import exact
from sitepulse.llm.common import work_dir
from tests.llm.conftest import SF, same_rows


def test_query_against_sql(spark):
    same_rows(exact.op3_exact_dedup(spark, SF), SF, exact.SQL)


def test_odd_rows(spark, documents):
    docs = documents([(9, "a  b"), (4, "a\t\nb"), (7, "a b"), (1, None), (2, ""), (3, " "),
                      (None, "a b"), (4, "a b"), (None, "only"), (20, "A b")])
    found = exact.DigestIndex(spark, work_dir(spark, "t")).assign(docs).collect()
    assert len(found) == 10
    by_text = {}
    for r in found:
        by_text.setdefault(r["text_sha256"], []).append(r)
    ab = by_text[hashlib.sha256(b"a b").hexdigest()]
    assert {r["keep_id"] for r in ab} == {4} and {r["group_size"] for r in ab} == {5}
    assert sum(r["kept"] for r in ab) == 2  # the repeated row of document 4
    assert [r["keep_id"] for r in by_text[hashlib.sha256(b"only").hexdigest()]] == [None]
    assert {r["keep_id"] for r in by_text[hashlib.sha256(b"").hexdigest()]} == {1}
    kept = exact.DigestIndex(spark, work_dir(spark, "t")).dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 20]
    assert kept.where("doc_id = 4").count() == 1 and kept.where("doc_id = 9").count() == 0


def test_index_persists_and_later_batches_meet_it(spark, documents):
    folder = work_dir(spark, "index")
    first = exact.DigestIndex(spark, folder, 4)
    assert first.dedup(documents([(5, "x"), (6, "y")])).count() == 2
    again = exact.DigestIndex(spark, folder, 4)
    batch = documents([(1, "x"), (2, "z"), (3, "z")])
    rows = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.assign(batch).collect()}
    assert rows == {1: (5, False), 2: (2, True), 3: (2, False)}
    # The same batch once more changes nothing.
    rows = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.assign(batch).collect()}
    assert rows == {1: (5, False), 2: (2, True), 3: (2, False)}
    assert again.rows().count() == 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_is_read_as_it_lies(spark, documents):
    """Neither an exchange nor a sort on the index side, however many batches came before."""
    index = exact.DigestIndex(spark, work_dir(spark, "index"), 4)
    for n, size in enumerate([400, 90, 20, 4]):
        index.dedup(documents([(1000 * n + i, f"{n}:{i}") for i in range(size)])).count()
    assert [(r.first, r.last) for r in index.runs()] == [(1, 1), (2, 2), (3, 3), (4, 4)]
    groups = documents([(i, str(i)) for i in range(50)]).select(
        exact.text_digest().alias("digest"), F.col("doc_id").alias("keep_id"))
    with exact.ordered_scans(spark):
        for df, joins in ((index.unknown(groups), 4), (index.owners(groups), 4)):
            plan = plan_of(df)
            assert plan.count("SortMergeJoin") == joins and plan.count("Bucketed: true") == joins
            # The batch alone is dealt out and sorted; a plan for several joins may repeat that.
            for line in index_sides(plan):
                assert "Sort" not in line and "Exchange" not in line
    # After the block Spark plans as before.
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering", "false") == "false"


def depth(line):
    return max(line.find("- "), 0)


def index_sides(plan):
    """The operators between each scan of an index table and the join above it."""
    lines = plan.splitlines()
    for at, line in enumerate(lines):
        if "FileScan" not in line or "Bucketed: true" not in line:
            continue
        above, level = [], depth(line)
        for upper in reversed(lines[:at]):
            if depth(upper) < level:
                level = depth(upper)
                if "SortMergeJoin" in upper:
                    break
                above.append(upper)
        yield " ".join(above)


def test_runs_are_merged_and_have_one_file_a_bucket(spark, documents):
    index = exact.DigestIndex(spark, work_dir(spark, "index"), 4)
    for n in range(9):
        batch = documents([(100 * n + i, f"{n}:{i}") for i in range(50)] + [(9000 + n, "0:7")])
        rows = index.assign(batch)
        assert rows.where("kept").count() == 50
        assert rows.where("doc_id >= 9000").first()["keep_id"] == 7
        assert len(index.runs()) <= 4
    assert index.rows().count() == 450 == index.rows().select("digest").distinct().count()
    for run in index.runs():
        files = index.read(run).inputFiles()
        assert len(files) == len({f.rsplit("_", 1)[1] for f in files}) <= 4
    assert index.assign(documents([])).count() == 0
    before = index.runs()
    index.append(spark.createDataFrame([], "digest string, keep_id bigint"))
    assert index.runs() == before  # nothing new: no run
    index.vacuum()
    assert index.runs() == before == sorted(index._finished())
    assert index.rows().count() == 450


def test_half_written_run_does_not_count_and_bucket_numbers_may_differ(spark, documents):
    folder = work_dir(spark, "index")
    index = exact.DigestIndex(spark, folder, 4)
    index.assign(documents([(i, f"t{i}") for i in range(40)])).count()
    hadoop, root, fs = index._files()
    fs.mkdirs(hadoop.Path(f"{folder}/run-2-2-4"))
    fs.create(hadoop.Path(f"{folder}/run-2-2-4/part-0.parquet")).close()
    index.close()
    other = exact.DigestIndex(spark, folder, 7)
    assert [r.last for r in other.runs()] == [1]
    rows = other.assign(documents([(100 + i, f"t{i}") for i in range(30, 45)])).collect()
    assert sum(r["kept"] for r in rows) == 5
    assert {r["keep_id"] for r in rows if not r["kept"]} == set(range(30, 40))
    assert other.rows().count() == 45


def test_query_leaves_no_table_in_the_catalog(spark, documents, folder):
    path = folder(documents=documents([(1, "a"), (2, "a")]))
    names = {t.name for t in spark.catalog.listTables()}
    assert exact.op3_exact_dedup(spark, path).where("kept").count() == 1
    assert {t.name for t in spark.catalog.listTables()} == names


def test_hot_text_and_clashing_columns(spark, documents):
    docs = documents([(i, "hot" if i % 3 else f"t{i}") for i in range(900)]).selectExpr(
        "*", "'x' as digest", "7 as keep_id", "true as kept", "'y' as _digest")
    found = exact.DigestIndex(spark, work_dir(spark, "t")).assign(docs)
    assert found.where("group_size = 600 and keep_id = 1").count() == 600
    assert found.where("kept").count() == 301


def test_empty_table(spark, documents):
    assert exact.DigestIndex(spark, work_dir(spark, "t")).assign(documents([])).count() == 0
    assert exact.exact_stage(spark, documents([]), "").count() == 0
