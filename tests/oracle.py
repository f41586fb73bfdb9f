"""Compare a Spark result with DuckDB, by column name, type class and values."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql):
    """None if equal, else a short text."""
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    types = {d[0]: d[1] for d in con.execute(f"DESCRIBE {sql}").fetchall() for d in [(d[0], d[1])]}
    if ours != types:
        return f"schema: ours {ours}, theirs {types or theirs}"
    columns = sorted(ours)
    order = [list(theirs).index(c) for c in columns]
    expected = sorted(
        (tuple(row[i] for i in order) for row in con.execute(sql).fetchall()), key=repr)
    actual = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    if len(expected) != len(actual):
        return f"rows: ours {len(actual)}, theirs {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"first difference: ours {a}, theirs {b}"
    return None
