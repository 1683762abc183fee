"""Side-by-side runs of the registered queries on Spark and DuckDB."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def spark_types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema}


SAME = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date",
    "BOOLEAN": "boolean",
}


def difference(df, con, sql):
    """None if both give the same columns, types and rows, else a description."""
    found = con.execute(sql)
    types = {d[0]: SAME.get(str(d[1]), str(d[1])) for d in found.description}
    expected = rows_of(list(types), found.fetchall())
    mine = spark_types(df)
    if mine != types:
        wrong = {k: (mine.get(k), types.get(k)) for k in mine.keys() | types.keys() if mine.get(k) != types.get(k)}
        return f"schema differs (spark, sql): {wrong}"
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"rows differ: {a} / {b}"
    return None
