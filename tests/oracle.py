"""Run a registered query and its SQL oracle on the same tables and compare the rows."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(file))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def rows_by_name(columns, rows):
    """Rows with columns in name order, as a sorted list of texts."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """(spark, duckdb) pairs of column names and of rows."""
    result = query(spark, sf_dir)
    ours = rows_by_name(result.columns, [tuple(r) for r in result.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = rows_by_name(names, answer.fetchall())
    return ours, theirs
