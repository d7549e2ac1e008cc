"""Which label catalogue serves a locale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import trimmed

# The language the labels are written in, and how a locale is spelled.
SOURCE_LANGUAGE = "en"
LOCALE = r"^([a-zA-Z]{2,3})(?:_([a-zA-Z]{4}))?(?:_([a-zA-Z0-9]{2,4}))?\z"

# The shipped catalogues.
CATALOGUES = (
    "cs_CZ", "da_DK", "de_DE", "el", "en_GB", "es_ES", "fi", "fr_FR", "id_ID", "it_IT", "ja", "nb_NO",
    "nl_NL", "pl_PL", "pt_BR", "pt_PT", "ro_RO", "ru_RU", "sv_SE", "tr_TR", "uk", "vi", "zh_CN",
)


def catalogue_frame(spark: SparkSession, names: tuple[str, ...] = CATALOGUES) -> DataFrame:
    """The catalogues as a literal relation, whose size Spark knows."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("catalogue"))


def resolve_locales(rows: DataFrame, catalogues: DataFrame, locale: str = "locale") -> DataFrame:
    """Adds ``catalogue``: the exact language and region, else the only catalogue of the
    language. English never falls back, and neither does a locale that names a script: a
    near match would replace right text with wrong text."""
    text = F.replace(trimmed(F.coalesce(F.col(locale), F.lit(""))), F.lit("-"), F.lit("_"))
    region = F.upper(F.regexp_extract(text, LOCALE, 3))
    read = rows.withColumns(
        {
            "_language": F.lower(F.regexp_extract(text, LOCALE, 1)),
            "_script": F.regexp_extract(text, LOCALE, 2),
            "_exact": F.lower(F.concat_ws("_", F.regexp_extract(text, LOCALE, 1), F.when(region != "", region))),
        }
    )
    exact = catalogues.select(F.lower("catalogue").alias("_exact"), F.col("catalogue").alias("_exact_name"))
    only = (
        catalogues.groupBy(F.lower(F.substring_index("catalogue", "_", 1)).alias("_language"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("catalogue").alias("_only_name"))
        .where((F.col("_n") == 1) & (F.col("_language") != SOURCE_LANGUAGE))
        .drop("_n")
    )
    fallback = F.when(F.col("_script") == "", F.col("_only_name"))
    return (
        read.join(exact, "_exact", "left")
        .join(only, "_language", "left")
        .withColumn("catalogue", F.coalesce("_exact_name", fallback))
        .drop("_language", "_script", "_exact", "_exact_name", "_only_name")
    )
