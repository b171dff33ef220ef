"""Column encryption: AES in CBC mode with a fixed vector, base64 text.

Keys and vectors are parameters of the caller; none is stored here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True, repr=False)
class CipherKey:
    """Secret of a cipher: 16, 24 or 32 key bytes and a 16-byte vector."""

    key: bytes
    iv: bytes

    def __post_init__(self):
        if len(self.key) not in (16, 24, 32) or len(self.iv) != 16:
            raise ValueError("key must have 16, 24 or 32 bytes and the vector 16")


def encrypt(value, secret: CipherKey) -> Column:
    """Base64 text of the encrypted value."""
    sealed = F.aes_encrypt(_col(value), F.lit(bytearray(secret.key)), F.lit("CBC"),
                           F.lit("PKCS"), F.lit(bytearray(secret.iv)))
    # Spark puts the vector in front; the interchange layout has none
    return F.base64(F.substring(sealed, 17, 2147483647))


def decrypt(value, secret: CipherKey) -> Column:
    """Plain text, or null when the value cannot be decrypted."""
    sealed = F.concat(F.lit(bytearray(secret.iv)),
                      F.try_to_binary(_col(value), F.lit("base64")))
    return F.try_aes_decrypt(sealed, F.lit(bytearray(secret.key)), F.lit("CBC"),
                             F.lit("PKCS")).cast("string")


def encrypt_columns(df: DataFrame, columns, secret: CipherKey) -> DataFrame:
    return df.withColumns({c: encrypt(c, secret) for c in columns})


def decrypt_columns(df: DataFrame, columns, secret: CipherKey) -> DataFrame:
    return df.withColumns({c: decrypt(c, secret) for c in columns})


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
