"""Column encryption with AES.  The key is the caller's; nothing here holds one.

A key in a literal would stand in every plan text, and so in the web page and the event log of the
session.  It therefore comes out of a one-row table by a scalar subquery, of which plans show the name only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PADDING = {"ECB": "PKCS", "CBC": "PKCS", "GCM": "NONE"}


def _hidden(spark: SparkSession, key: str) -> Column:
    return spark.createDataFrame([(key,)], "key string").scalar()


def encrypt_column(df: DataFrame, column: str, key: str, out: str, mode: str = "ECB") -> DataFrame:
    """Add ``out``: the UTF-8 text of ``column`` as AES ciphertext (16, 24 or 32 byte key).

    ECB gives equal text equal ciphertext, so it can be joined on but shows repeats.  GCM hides them
    and detects changes; its output differs on every run.
    """
    cipher = F.aes_encrypt(F.col(column).cast("string"), _hidden(df.sparkSession, key), F.lit(mode), F.lit(PADDING[mode]))
    return df.withColumn(out, cipher)


def decrypt_column(
    df: DataFrame, column: str, key: str, out: str, mode: str = "ECB", strict: bool = True
) -> DataFrame:
    """Add ``out``: the text behind ciphertext ``column``.

    A value that does not decrypt fails the job, or gives null with ``strict=False``.
    """
    decrypt = F.aes_decrypt if strict else F.try_aes_decrypt
    text = decrypt(F.col(column), _hidden(df.sparkSession, key), F.lit(mode), F.lit(PADDING[mode]))
    return df.withColumn(out, text.cast("string"))
