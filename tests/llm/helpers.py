"""Small tables with the hard cases, and brute-force helpers."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as documents, with columns whose names operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    for extra in ("fp", "piece", "count", "part", "ids", "hit", "shard", "root", "score", "text_key"):
        df = df.withColumn(extra, df.n_chars.cast("string"))
    return df


def sf_rows(name="documents", columns="doc_id, text", sf=SF):
    return duckdb.sql(f"select {columns} from '{sf}/{name}.parquet' order by 1").fetchall()


HARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "no id here"),
    (7, "tie tie tie " * 4000), (8, "Grüße, 北京 🎉 café x  y \n z"), (9, "<|endoftext|> as text"),
    (10, "x" * 100_000), (11, "line\n\nline\n\n\nline \n other"),
]
