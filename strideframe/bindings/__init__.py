"""Queries over the driver tables, grouped by operator family."""

from __future__ import annotations

import importlib

from strideframe.bindings import registry

MODULES = ["signals", "checks", "labels", "joins", "qa", "corpus", "ledger", "streams", "files"]


def load():
    for name in MODULES:
        importlib.import_module(f"strideframe.bindings.{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
