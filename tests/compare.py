"""Results as sorted rows of text, the same for Spark and DuckDB."""

import datetime


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return "null"
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return str(v.date())
    if isinstance(v, float) and v == int(v):
        return str(int(v))
    return str(v)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[c]) for c in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
