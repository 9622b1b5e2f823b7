"""What several test modules share."""


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(type(v)), v) for v in r])
