"""Helpers of the tests; no test imports ``conftest``, a name that folders share."""


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple(str(v) for v in row))
