"""Encrypt a column of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.operators.protect import decrypt_column, encrypt_column
from footfall.sources import read_table, replace_table


def build(people: DataFrame, key: str, column: str = "id_number", mode: str = "ECB") -> DataFrame:
    """The table with ``encrypted_id`` and, decrypted again, ``decrypted_id``."""
    sealed = encrypt_column(people, column, key, "encrypted_id", mode)
    return decrypt_column(sealed, "encrypted_id", key, "decrypted_id", mode)


def run(
    spark: SparkSession, people: str, sealed: str, key: str, column: str = "id_number", mode: str = "ECB", decrypt: bool = False
) -> None:
    """Write table ``sealed``: ``people`` with ``column`` replaced by its ciphertext ``encrypted_id``.

    ``decrypt`` is the way back: ``sealed`` is read, and ``people`` written with the plain ``column``.
    """
    if decrypt:
        replace_table(decrypt_column(read_table(spark, sealed), "encrypted_id", key, column, mode).drop("encrypted_id"), people)
    else:
        replace_table(encrypt_column(read_table(spark, people), column, key, "encrypted_id", mode).drop(column), sealed)
