"""Helpers shared by test modules."""


def rows(df, *cols):
    """Collect as a list of tuples (sorted) for compact assertions."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
