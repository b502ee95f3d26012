"""Stable salted buckets: the SHA-1 of ``salt|type|key`` read as one 160-bit number, modulo the bucket count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.text import _col

# The type names that are part of the hashed text.
STRING_KEY = "<class 'str'>"
INTEGER_KEY = "<class 'int'>"
LIST_KEY = "<class 'list'>"


def stable_bucket(salt: str, key: Column | str, buckets: int, kind: str = STRING_KEY) -> Column:
    """Bucket number in ``0 .. buckets-1``; the same key lands in the same bucket on every run and machine.

    5 and "5" are different keys, so the kind of key is hashed along with its text.
    """
    return hash_modulo(F.concat(F.lit(f"{salt}|{kind}|"), _col(key).cast("string")), buckets)


def hash_modulo(text: Column | str, divisor: int) -> Column:
    """SHA-1 of a text, as an unsigned 160-bit number, modulo ``divisor``.

    The 40 hex digits are taken in five 32-bit parts. With both factors below 2**31, no step leaves BIGINT.
    """
    if not 0 < divisor < 2**31:
        raise ValueError("divisor must lie between 1 and 2**31 - 1")
    digest = F.sha1(_col(text))
    shift = F.lit(2**32 % divisor).cast("bigint")
    remainder = F.lit(0).cast("bigint")
    for part in range(5):
        word = F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("bigint")
        remainder = (remainder * shift + word) % F.lit(divisor).cast("bigint")
    return remainder


def list_key(*items: Column | str, quoted: tuple[bool, ...]) -> Column:
    """Text of a composite key as a list, such as ``['a', 7]``; ``quoted`` tells which items are strings."""
    texts = [
        _quoted(_col(item)) if is_string else _col(item).cast("string")
        for item, is_string in zip(items, quoted, strict=True)
    ]
    return F.concat(F.lit("["), F.concat_ws(", ", *texts), F.lit("]"))


def _quoted(text: Column) -> Column:
    escaped = text
    for raw, shown in (("\\", r"\\"), ("\n", r"\n"), ("\r", r"\r"), ("\t", r"\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    only_single = text.contains("'") & ~text.contains('"')
    return F.when(only_single, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit(r"\'")), F.lit("'"))
    )
