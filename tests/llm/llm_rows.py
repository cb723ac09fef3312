"""Rows in an order that does not depend on the engine."""


def rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
