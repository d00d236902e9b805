"""Helpers of the tests (a module of its own name, so no conftest can hide it)."""

from __future__ import annotations

SMOKE = "/root/testdata/sf0.001"


def rows(df, *cols, order=None):
    """Collect a small test frame as tuples (sorted for stable comparison)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
