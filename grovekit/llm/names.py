"""Names for helper columns beside columns of any name."""


def fresh(df, stem):
    """``stem``, with underscores before it until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem
