"""Personal data: masked and secured copies, decrypted columns."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def masked(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Each PII column an empty string, whatever its type; names match in any case, unknown ones are ignored."""
    wanted = {c.lower() for c in columns}
    return df.withColumns({c: F.lit("") for c in df.columns if c.lower() in wanted})


def split(df: DataFrame, columns: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(secured, masked): the same rows from one plan, for two sinks."""
    return df, masked(df, columns)


def decrypted(df: DataFrame, columns: Iterable[str], decrypt) -> DataFrame:
    """<c>_decrypted for each column: decrypt(column) of what isn't null or empty, else null."""
    return df.withColumns({f"{c}_decrypted": F.when(F.col(c) > "", decrypt(F.col(c))) for c in columns})


def aes(key: str):
    """decrypt function for base64 texts that aes_encrypt made with this key."""

    def run(c: Column) -> Column:
        return F.aes_decrypt(F.unbase64(c), F.lit(key)).cast("string")

    return run
