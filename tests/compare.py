"""Row-by-row comparison of a Spark frame with a DuckDB query."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    return names, kinds, cursor.fetchall()


def in_name_order(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    def key(row):
        return [(v is None, str(type(v)), v if v is not None else 0) for v in row]
    return sorted(names), sorted((tuple(row[i] for i in at) for row in rows), key=key)


KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def assert_same(df, con, sql: str):
    names, kinds, expected = sql_rows(con, sql)
    assert {n: KIND[t] for n, t in df.dtypes} == kinds
    got = [tuple(r) for r in df.collect()]
    columns, ours = in_name_order(df.columns, got)
    _, theirs = in_name_order(names, expected)
    differing = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]][:2]
    # a plain comparison of long lists would print them whole
    assert (len(ours), differing) == (len(theirs), []), columns
    assert got
