"""A small hand-checked shop, and a Spark session."""

from __future__ import annotations

import csv
import json
import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.operators.cleaning import clean_all  # noqa: E402
from tallyloom.operators.star import enrich_all, star_of  # noqa: E402
from tallyloom.params import MartParams  # noqa: E402
from tallyloom.plans.job import build_star  # noqa: E402
from tallyloom.schemas import RAW  # noqa: E402
from tallyloom.session import build_session, release_staged  # noqa: E402

SF = "/root/testdata/sf0.001"

# A small outdoor shop of our own; its results are worked out by hand in FIXTURES.md.
ROWS = {
    "customers": [
        ("K17", "Ida Brandt", "ida@shop.example", "Alps", "Innsbruck", "B2C", "2024-02-03"),
        ("K23", "Noor Haddad", "noor@shop.example", "Coast", "Rostock", "B2B", "2024-02-19"),
        ("K41", "Tom Okafor", "tom@shop.example", "Coast", "Husum", "B2C", "2024-04-28"),
        ("K58", "Mara Lindt", "mara@shop.example", "Alps", "Graz", "B2B", "2024-05-06"),
    ],
    "suppliers": [
        ("L1", "Elbe Parts KG", "PL", 9, 4.1),
        ("L2", "Orient Trade SE", "VN", 31, 2.8),
        ("L3", "Fjord Gear AS", "NO", 14, 3.6),
    ],
    "products": [
        ("A10", "Ridge Tent", "Tents", "Two Person", "Norvex", "L2", 110.0, 240.0),
        ("A20", "Gas Stove", "Kitchen", "Stoves", "Linnea", "L1", 18.0, 45.0),
        ("A30", "Tin Mug", "Kitchen", "Cups", "Movo", "L1", 3.0, 8.0),
        ("A40", "Head Lamp", "Light", "Lamps", "Movo", "L3", 12.5, 20.0),
    ],
    "orders": [
        ("B-101", "K23", "A10", 2, 235.5, 0.0, "2024-02-22", "completed"),
        ("B-102", "K17", "A20", 1, 44.0, 15.0, "2024-03-09", "completed"),
        ("B-103", "K41", "A30", 10, 7.5, 4.0, "2024-05-02", "completed"),
        ("B-104", "K17", "A10", 1, 240.0, 0.0, "2024-05-14", "cancelled"),
        ("B-105", "K23", "A30", 4, 8.0, 0.0, "2024-08-11", "completed"),
        ("B-106", "K17", "A20", 3, 45.0, 10.0, "2024-08-30", "completed"),
    ],
    "returns": [
        ("RT-1", "B-103", "2024-05-20", "dented"),
        ("RT-2", "B-102", "2024-03-30", "too small"),
    ],
    "shipping": [
        ("B-101", "Posthorn", "2024-02-23", "2024-02-27", 11.9),
        ("B-102", "Kurier", "2024-03-11", "2024-03-12", 4.2),
        ("B-103", "Posthorn", "2024-05-03", "2024-05-08", 5.6),
        ("B-105", "Kurier", "2024-08-12", "2024-08-13", 3.1),
        ("B-106", "Radbote", "2024-09-02", "2024-09-04", 8.4),
    ],
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def params():
    return MartParams(date_end=date(2024, 12, 31))


@pytest.fixture(scope="session")
def frame(spark):
    """A raw source from rows; given rows replace the sample rows."""

    def make(name, rows=None):
        return spark.createDataFrame(ROWS[name] if rows is None else rows, RAW[name]).coalesce(1)

    return make


@pytest.fixture(scope="session")
def sources(frame):
    return {name: frame(name) for name in ROWS}


@pytest.fixture(scope="session")
def star(sources, params):
    """The sample star with surrogate keys."""
    return build_star(enrich_all(clean_all(sources)), params, order_keys="source")


@pytest.fixture(scope="session")
def lazy_star(sources, params):
    return star_of(sources, params)


@pytest.fixture
def make_star(sources, params):
    """A lazy star with some sources replaced."""

    def make(**replaced):
        return star_of({**sources, **replaced}, params)

    return make


@pytest.fixture
def data_dir(tmp_path):
    write_raw(tmp_path)
    return str(tmp_path)


def write_raw(folder, rows=ROWS):
    raw = Path(folder) / "raw"
    raw.mkdir(exist_ok=True)
    for name in ("orders", "customers", "returns"):
        with open(raw / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(RAW[name].fieldNames())
            writer.writerows(rows[name])
    for name, target in (
        ("products", "products.json"),
        ("suppliers", "suppliers.json"),
        ("shipping", "shipping_events.json"),
    ):
        names = RAW[name].fieldNames()
        with open(raw / target, "w") as out:
            json.dump([dict(zip(names, row, strict=True)) for row in rows[name]], out)


def rows_of(df, *columns):
    """Sorted tuples of some columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
