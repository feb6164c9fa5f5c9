"""Every operator run on the given tables, next to the plain SQL that must agree with it."""

from __future__ import annotations

import importlib

MODULES = ("scalars", "tracks", "stats", "rasters", "neighbours", "traces", "clusters", "cubes", "files", "survey")


def registry():
    """(queries, oracle SQL) by name."""
    from soundlake.checks import base

    for m in MODULES:
        importlib.import_module(f"soundlake.checks.{m}")
    return base.QUERIES, base.ORACLE
