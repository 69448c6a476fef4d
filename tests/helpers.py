"""Small helpers of the tests."""

import contextlib
import io


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def ordered(expected):
    return sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df):
    """The physical plan as text."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
