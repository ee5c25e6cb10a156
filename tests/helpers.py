"""What several test modules use."""

from datetime import date, datetime


def rows_of(df, *order):
    """Rows as tuples, sorted by the given columns or by their text."""
    rows = [tuple(r) for r in df.collect()]
    if order:
        places = [df.columns.index(c) for c in order]
        return sorted(rows, key=lambda r: [(r[p] is not None, r[p]) for p in places])
    return sorted(rows, key=str)


def day(text):
    return date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)
