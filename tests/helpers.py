"""Helpers of the tests; not in a conftest, of which there is one per folder."""


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
