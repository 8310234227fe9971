"""Names that several test modules share."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, cols=None):
    """Sorted list of tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.select(*cols).collect()], key=repr)
