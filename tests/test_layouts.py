"""The distributed layout resolution equals the per-layout driver rules."""
import random

from keystitch.plans.headers import NoKeyColumns, plan_layout
from keystitch.plans.layouts import plan_layouts
from keystitch.spec import DEFAULT_ALIASES, EnrichSpec

POOL = [h for h, _ in DEFAULT_ALIASES] + ["PNR_Number", "Airline_Code", "Travel_Sector", "Qty", "Taxable_Amount",
                                          "Cgst_Total", "CGST", "note"]


def variant(rng, h):
    r = rng.random()
    if r < 0.3:
        return h.upper()
    if r < 0.5:
        return " " + h + "\t"
    return h


def test_distributed_resolution_matches_driver(spark):
    rng = random.Random(7)
    spec = EnrichSpec()
    layouts = []
    for i in range(120):
        cols, seen = [], set()
        for _ in range(rng.randint(1, 12)):
            h = variant(rng, rng.choice(POOL))
            if h not in seen:            # labels are unique after the reader's de-duplication
                seen.add(h)
                cols.append(h)
        layouts.append((f"L{i}", cols))
    rows = [(lid, pos, h) for lid, cols in layouts for pos, h in enumerate(cols)]
    got = {r["layout_id"]: r for r in plan_layouts(
        spark.createDataFrame(rows, "layout_id string, pos int, header string"), spec).collect()}
    with_keys = 0
    for lid, cols in layouts:
        try:
            plan = plan_layout(cols, spec)
            want = (list(plan.keys), [s[0] for s in plan.sources], [t for t, _ in plan.missing])
            with_keys += 1
        except NoKeyColumns:
            want = (None, None, [t for t in spec.target_columns if t not in cols])
        r = got[lid]
        assert (r["keys"], r["sources"], r["missing"]) == want, (lid, cols)
    assert 10 <= with_keys <= 110   # both outcomes are exercised
