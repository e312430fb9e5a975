"""Spark rows and SQL rows of a query, in an order that does not depend on either."""

import math
from pathlib import Path

import duckdb


def connection(folder):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def rows_of(df):
    """Rows of a Spark or pandas DataFrame by sorted columns, as comparable text."""
    pdf = df.toPandas() if hasattr(df, "toPandas") else df
    columns = sorted(pdf.columns)
    pdf = pdf[columns].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return columns, sorted(repr(tuple(map(plain, r))) for r in pdf.itertuples(index=False, name=None))
