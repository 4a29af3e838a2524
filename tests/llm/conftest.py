import glob
import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """documents([(doc_id, text), ...] or [(doc_id, text, source), ...]) with the table's columns."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "src", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def folder(tmp_path):
    """folder(documents=df, ...): a table folder as the queries read it."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


def duck(folder, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"create view {name} as select * from '{source}'")
    out = con.sql(sql)
    return out.columns, out.fetchall()


def same_rows(df, folder, sql):
    """The query's rows are the SQL's rows (columns in any order, doubles to nine digits)."""
    columns, rows = duck(folder, sql)

    def tidy(names, values):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return sorted((tuple(round(v[i], 9) if isinstance(v[i], float) else v[i] for i in order)
                       for v in values), key=str)

    assert sorted(df.columns) == sorted(columns)
    assert tidy(df.columns, [tuple(r) for r in df.collect()]) == tidy(columns, rows)
