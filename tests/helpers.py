"""Small utilities for the tests."""

from __future__ import annotations

import json


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def column(spark, rows, dtype, expression):
    """``expression`` applied to one column ``v``, in input order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {dtype}")
    out = df.select("i", expression(F.col("v")).alias("o")).collect()
    return [r.o for r in sorted(out, key=lambda r: r.i)]


def landing_line(**fields):
    return json.dumps(fields, ensure_ascii=False)


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
