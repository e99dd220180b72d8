"""Comparison of a query with its SQL on the same tables."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of_sql(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    db.execute(f"CREATE TABLE o AS {sql}")
    names = sorted(r[0] for r in db.execute("DESCRIBE o").fetchall())
    return names, db.execute(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM o").fetchall()


def assert_same(df, sql: str, sf_dir: str) -> None:
    names, wanted = rows_of_sql(sql, sf_dir)
    assert sorted(df.columns) == names
    got = [tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()]

    def key(row):
        return tuple((x is None, round(x, 9) if isinstance(x, float) else x) if x is not None else (True, 0) for x in row)

    assert sorted(map(str, map(key, got))) == sorted(map(str, map(key, wanted)))
