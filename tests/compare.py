"""Order-insensitive comparison of a Spark result with the same query in DuckDB."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SPARK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_result(df):
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(row[n] for n in names) for row in df.select(*names).collect()]
    return [(n, SPARK_TYPES[types[n]]) for n in names], _sorted(rows)


def duckdb_result(con, sql):
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: row[1] for row in described}
    names = sorted(types)
    columns = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"SELECT {columns} FROM ({sql})").fetchall()
    return [(n, types[n]) for n in names], _sorted(rows)
