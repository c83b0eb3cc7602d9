"""Property tests: random panels, Spark operators vs a plain-pandas brute force."""

import datetime as dt
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricelens import operators as ops

SCHEMA = ("product_id string, store string, name string, brand string, link string, image string, "
          "is_available boolean, scrape_date date, list_price double, price double")
DATES = [dt.date(2026, 3, 1) + dt.timedelta(days=7 * i) for i in range(6)]

cell = st.tuples(st.sampled_from([None, 0.0, 5.0, 10.0, 12.5, 20.0, 33.33]),
                 st.sampled_from([None, 0.0, 4.0, 10.0, 11.11, 25.0]),
                 st.sampled_from([True, True, False, None]))
panel = st.dictionaries(
    st.tuples(st.sampled_from([f"p{i}" for i in range(8)]), st.sampled_from(["a", "b"]),
              st.sampled_from(range(len(DATES)))),
    cell, min_size=1, max_size=40)


def frame(spark, cells):
    rows = [(p, s, "n", "b", "l", "i", av, DATES[d], lp, pr) for (p, s, d), (lp, pr, av) in cells.items()]
    return spark.createDataFrame(rows, SCHEMA)


def brute_changes(cells):
    present = sorted({d for (_, _, d) in cells}, reverse=True)[:2]
    if len(present) < 2:
        return set()
    latest, prev = present[0], present[1]
    out = set()
    for (p, s, d), (lp, pr, av) in cells.items():
        if d != latest or av is not True or (p, s, prev) not in cells:
            continue
        plp, ppr, _ = cells[(p, s, prev)]
        if plp is None or ppr is None or not (plp > 0 and ppr > 0):
            continue
        # three-valued OR: a NULL difference is unknown, the other one can still be true
        moved_list = None if lp is None else lp - plp != 0
        moved_price = None if pr is None else pr - ppr != 0
        if moved_list is True or moved_price is True:
            out.add((p, s, lp, pr, plp, ppr))
    return out


def r2(x):
    return math.floor(x * 100 + 0.5) / 100


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(cells=panel)
def test_price_changes_matches_brute_force(spark, cells):
    df = frame(spark, cells)
    for method in ("join", "lag"):
        got = {(r.product_id, r.store, r.list_price, r.price, r.prev_list_price, r.prev_price)
               for r in ops.price_changes(df, method=method).collect()}
        assert got == brute_changes(cells)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(cells=panel, k=st.integers(1, 3))
def test_avg_deals_matches_brute_force(spark, cells, k):
    df = frame(spark, cells)
    pdf = pd.DataFrame([(p, s, DATES[d], pr, av) for (p, s, d), (lp, pr, av) in cells.items()],
                       columns=["product_id", "store", "d", "price", "av"])
    latest = pdf.d.max()
    win = pdf[(pdf.d >= latest - dt.timedelta(days=30)) & (pdf.d < latest) & pdf.price.notna()]
    avg = {key: r2(sum(math.floor(x * 10000 + 0.5) for x in g.price) / 10000 / len(g))
           for key, g in win.groupby(["product_id", "store"])}
    cand = []
    for r in pdf[(pdf.d == latest) & (pdf.av == True)].itertuples():  # noqa: E712
        a = avg.get((r.product_id, r.store))
        if a is not None and r.price is not None and not math.isnan(r.price) and a > 0 and r.price < a:
            cand.append((r.store, -((a - r.price) / a), r.product_id, a, r.price))
    want = set()
    for store in {c[0] for c in cand}:
        ranked = sorted(c for c in cand if c[0] == store)
        for i, (s, _, pid, a, price) in enumerate(ranked[:k], start=1):
            want.add((s, pid, a, price, r2((a - price) / a * 100), i))
    got = {(r.store, r.product_id, r.avg_price_30d, r.current_price, r.pct_discount, r["rank"])
           for r in ops.avg_deals_30d(df, k=k).collect()}
    assert got == want
