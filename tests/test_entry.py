"""The registered queries, with and without the optional document operators."""

from __future__ import annotations

import importlib
import sys


def test_every_sql_belongs_to_a_query():
    import __spark_entry__ as entry

    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert {"price_updates", "nightly_batch", "follow_updates"} <= entry.queries().keys()


def test_entry_without_document_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # as if it were not there
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries().keys()
    assert "price_updates" in names and "pipeline" not in names
    assert entry.oracle_sql().keys() <= names
