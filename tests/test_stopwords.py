"""The default stop words and the oracle need no Spark jar."""

import pyspark

import __spark_entry__ as entry
from reelsim.functions import text


def test_entry_needs_no_jars(tmp_path, monkeypatch):
    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "__init__.py"))
    text.spark_english_stop_words.cache_clear()
    text.default_stop_words.cache_clear()
    assert len(text.spark_english_stop_words()) == 181
    assert len(text.default_stop_words()) == 202
    assert set(entry.oracle_sql()) <= set(entry.queries())
