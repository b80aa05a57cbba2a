from pathlib import Path

import pytest

SMALL = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, source]) rows."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with the given tables, as the queries read them."""

    def make(**frames):
        for name, frame in frames.items():
            frame.write.parquet(str(Path(tmp_path) / f"{name}.parquet"))
        return str(tmp_path)

    return make


@pytest.fixture
def small_bounds_off(monkeypatch):
    """No table fits a broadcast: lookups are salted joins."""
    from askframe.operators import presence

    monkeypatch.setattr(presence, "fits_broadcast", lambda *_: False)
    monkeypatch.setattr(presence, "BROADCAST_ROWS", -1)
