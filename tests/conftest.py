import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from pricelens.session import configure  # noqa: E402

SF001 = "/root/testdata/sf0.001"

#: The newest snapshot, the one before, and the last day that the 30-day average still takes.
LATEST, PREV, EDGE = dt.date(2025, 11, 20), dt.date(2025, 11, 13), dt.date(2025, 10, 21)


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("pricelens-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pricelens-test-ckpt-"))
    configure(s)
    yield s


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)


#: id -> store, earlier day, (list price, sale price) on that day and on the newest
SEED = {
    "milk": ("north", PREV, (40, 38), (50, 38)),        # list price up
    "bread": ("north", PREV, (20, 19), (22, 19)),
    "soap": ("south", PREV, (16, 16), (40, 16)),
    "brush": ("south", PREV, (25, 21), (30, 21)),
    "rice": ("north", PREV, (80, 55), (60, 55)),        # list price down
    "beans": ("north", PREV, (50, 30), (45, 30)),
    "towel": ("south", PREV, (120, 110), (90, 66)),     # both down
    "tea": ("north", PREV, (64, 64), (64, 16)),         # sale price down
    "salt": ("north", PREV, (10, 10), (10, 7)),
    "oil": ("south", PREV, (70, 70), (70, 84)),         # sale price up: a change, but in no report
    "sugar": ("north", PREV, (33, 31), (33, 31)),       # no change
    "lamp": ("north", EDGE, (300, 300), (300, 60)),     # only the average sees the earlier day
    "chair": ("north", EDGE, (400, 250), (400, 150)),
    "desk": ("south", EDGE, (900, 800), (900, 200)),
}

SEED_SCHEMA = ("product_id string, store string, name string, brand string, link string, image string, "
               "is_available boolean, scrape_date date, list_price double, price double")


def seed_rows(extra=()):
    """Two rows a product, and ``extra``."""
    def on(pid, store, day, prices):
        listed, paid = map(float, prices)
        return (pid, store, pid.title(), "House", f"https://shop.example/{store}/{pid}", f"https://shop.example/{pid}.png",
                True, day, listed, paid)

    return [r for pid, (store, day, before, after) in SEED.items()
            for r in (on(pid, store, day, before), on(pid, store, LATEST, after))] + list(extra)


@pytest.fixture()
def seed(spark):
    return spark.createDataFrame(seed_rows(), SEED_SCHEMA)
