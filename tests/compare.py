"""Rows of a Spark query and of its SQL, in a form that can be compared."""

import glob
import math
import os


def plain(value):
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((repr(tuple(plain(r.asDict(True)[n]) for n in names)) for r in df.collect()))


def rows_of_sql(sql, folder):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path if os.path.isfile(path) else path + "/*.parquet"}'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr(tuple(plain(r[i]) for i in order)) for r in result.fetchall())
