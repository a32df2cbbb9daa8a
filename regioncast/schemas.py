"""Result schemas of the three queries (names, order and types as the reference
writes them).

The reference declares every output field non-nullable, and so do these.
``conform`` fixes column order and types and makes each field non-nullable: a NULL
in a result fails the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, False) for name, dtype in fields])


QUERY1 = _schema(("mese", StringType()), ("regione", StringType()), ("numero_medio_vaccini", LongType()))
QUERY2 = _schema(("giorno", StringType()), ("fascia_eta", StringType()), ("regione", StringType()),
                 ("predizione_vaccini", IntegerType()))
QUERY3_SHARES = _schema(("regione", StringType()), ("giorno", StringType()),
                        ("predizione_percentuale_vaccini", DoubleType()))
QUERY3_CLUSTERS = _schema(("modello", StringType()), ("k", IntegerType()), ("regione", StringType()),
                          ("percentuale_vaccinati", DoubleType()), ("cluster", IntegerType()))
QUERY3_MODELS = _schema(("modello", StringType()), ("k", IntegerType()), ("performance_ms", LongType()),
                        ("cost_WSSSE", DoubleType()))

RESULTS = {
    "q1": QUERY1,
    "q2": QUERY2,
    "q3_share": QUERY3_SHARES,
    "q3_cluster": QUERY3_CLUSTERS,
    "q3_model": QUERY3_MODELS,
}


_FILL = {StringType: "", IntegerType: 0, LongType: 0, DoubleType: 0.0}


def _never_null(field: StructField) -> Column:
    """The column with a check on every value; the constant behind it only tells Spark that the result has no NULL."""
    c = F.col(f"`{field.name}`")
    checked = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in result column '{field.name}'")).cast(field.dataType)).otherwise(c)
    return F.coalesce(checked, F.lit(_FILL[type(field.dataType)])).alias(field.name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``df`` in the order and types of ``schema`` (by name; safe casts only), non-nullable where it says so."""
    typed = df.to(StructType([StructField(f.name, f.dataType, True) for f in schema.fields]))
    return typed.select(*(F.col(f"`{f.name}`") if f.nullable else _never_null(f) for f in schema.fields))
