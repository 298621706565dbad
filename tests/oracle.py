"""Runs a registered query and its SQL check and compares rows, names and types."""

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(kind: pa.DataType) -> str:
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return f"list<{_plain(kind.value_type)}>"
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    cols = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    rows = [
        tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in zip(*cols)
    ]
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark_table: pa.Table, check: pa.Table) -> list[str]:
    """Differences, empty if the two tables agree."""
    issues = []
    mine = {f.name: _plain(f.type) for f in spark_table.schema}
    theirs = {f.name: _plain(f.type) for f in check.schema}
    if mine != theirs:
        both = {c: (mine.get(c), theirs.get(c)) for c in sorted(mine.keys() | theirs.keys())
                if mine.get(c) != theirs.get(c)}
        issues.append(f"schema (spark, sql): {both}")
        if mine.keys() != theirs.keys():
            return issues
    if spark_table.num_rows != check.num_rows:
        issues.append(f"rows: spark {spark_table.num_rows}, sql {check.num_rows}")
    a, b = _rows(spark_table), _rows(check)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        issues.append(f"{len(wrong)} rows differ, first (columns {sorted(mine)}): "
                      f"{str(wrong[0][0])[:400]} != {str(wrong[0][1])[:400]}")
    return issues
