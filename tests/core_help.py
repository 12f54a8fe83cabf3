"""Helpers of the core tests, under a module name of their own."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns when none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
