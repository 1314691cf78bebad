"""Compare registered queries with their SQL; also runnable by hand.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {Path(path).stem} as select * from '{path}'")
    return connection


def _plain(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value)


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def _kind(name: str) -> str:
    name = name.lower()
    names = {
        "varchar": "string", "bigint": "bigint", "integer": "int", "timestamp": "timestamp",
        "timestamp_ntz": "timestamp", "boolean": "boolean", "double": "double",
    }
    return names.get(name, name)


def compare(spark, connection, name, query, sql, sf_dir):
    """Differences as text; empty when both sides agree."""
    frame = query(spark, sf_dir)
    spark_types = {f.name: _kind(f.dataType.simpleString()) for f in frame.schema.fields}
    spark_rows = normal_rows(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    sql_types = {item[0]: _kind(str(item[1])) for item in cursor.description}
    sql_rows = normal_rows(columns, cursor.fetchall())
    if sorted(spark_types) != sorted(sql_types):
        return f"columns {sorted(spark_types)} != {sorted(sql_types)}"
    if spark_types != {k: sql_types[k] for k in spark_types}:
        return f"types {spark_types} != {sql_types}"
    if spark_rows != sql_rows:
        extra = [r for r in spark_rows if r not in set(sql_rows)][:3]
        lost = [r for r in sql_rows if r not in set(spark_rows)][:3]
        return f"{len(spark_rows)} vs {len(sql_rows)} rows; only spark {extra}; only sql {lost}"
    return ""


def main() -> None:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, expected = connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, name, query, expected[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.2f}s {problem}", flush=True)


if __name__ == "__main__":
    main()
