"""Pseudonyms, fingerprints and content hashes as Catalyst expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def pseudonym(value: Column, salt: bytes, length: int = 16) -> Column:
    """The first hex digits of SHA-256(salt + UTF-8 text of ``value``); null stays null."""
    return F.substring(F.sha2(F.concat(F.unhex(F.lit(salt.hex())), F.encode(value.cast("string"), "UTF-8")), 256), 1, length)


def salt_fingerprint(salt: bytes) -> str:
    return hashlib.sha256(salt).hexdigest()


def uuid5(namespace: bytes, name: Column) -> Column:
    """Name-based UUID, version 5."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex())), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def row_key(columns: Sequence[str]) -> Column:
    """MD5 of the columns' texts joined by ``|`` (nulls are left out): a stable, order-free sampling key."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def hash_sample(df: DataFrame, columns: Sequence[str], n: int, tie: str) -> DataFrame:
    """The ``n`` rows with the smallest key: the same sample whatever the partitioning. Ties go to the smaller ``tie``."""
    return df.orderBy(row_key(columns), F.col(tie)).limit(n)


def content_hash(df: DataFrame) -> DataFrame:
    """One row with a hash of the content that no order or file layout changes: ``rows`` and ``content_hash``.

    Every row is hashed twice, independently, and both hashes are summed over all
    rows as decimals, so that repeated rows count as often as they occur and no
    pair of rows cancels. Columns are taken by name. An empty table has the hash
    of two zero sums.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in columns])  # the hash passes over nulls
    hashes = df.select(F.xxhash64(nulls, *columns).alias("a"), F.xxhash64(F.lit("second"), nulls, *columns).alias("b"))
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(28,0)")), F.lit(0)).cast("string")
    return hashes.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws("|", F.count(F.lit(1)), total("a"), total("b")), 256).alias("content_hash"))
