"""JSON validity of a text column."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sheaf.functions.text import _col


def is_json(text: Column | str) -> Column:
    """True when the whole text is one JSON value (strict: no NaN, no Infinity, no repeated object keys).

    ``try_parse_json`` stops after the first value and ignores what follows. The text is therefore parsed as
    the first element of a list whose second element is a hash of the text: anything beyond one value keeps the
    hash from showing up in second place.
    """
    value = _col(text)
    mark = F.xxhash64(value).cast("string")
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit(',"'), mark, F.lit('"]')))
    return F.coalesce(F.try_variant_get(listed, "$[1]", "string") == mark, F.lit(False))


def is_python_json(text: Column | str) -> Column:
    """True when Python's parser takes the text; meant for the few texts that :func:`is_json` turns down.

    The functions are local so that they travel with the job and executors need no copy of this package.
    """

    def accepted(value: str | None) -> bool:
        if value is None:
            return False
        try:
            json.loads(value)
        except (ValueError, RecursionError):
            return False
        return True

    def check(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(accepted).astype(bool)

    return F.pandas_udf(check, BooleanType())(_col(text))
