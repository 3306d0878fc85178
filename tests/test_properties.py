"""Model-based property test: enrich equals a plain-Python model of the
job's lookup (first match by tie-break, empty keys unmatched, no fan-out)."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keystitch import EnrichSpec, enrich

SPEC = EnrichSpec(key_combinations=[("A", "B")], aliases=[], targets=[("T", "T")], order_by=("O",))
KEY = st.sampled_from(["x", "y", " ", "", None, "X"])
NUM = st.sampled_from([1, 2, None])


def model(feed, ref):
    def empty(v):
        return v is None or (isinstance(v, str) and v.strip() == "")
    best = {}
    for a, b, t, o in ref:
        if a is None or b is None:
            continue
        k = (a, b)
        cand = (o is not None, o if o is not None else 0, t is not None, t if t is not None else 0.0)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, t)
    out = []
    for a, b, i in feed:
        hit = None if empty(a) or empty(b) else best.get((a, b))
        out.append((i, hit[1] if hit else None, hit is not None))
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(feed=st.lists(st.tuples(KEY, NUM), min_size=0, max_size=12),
       ref=st.lists(st.tuples(KEY, NUM, st.sampled_from([1.0, 2.0, None]), st.sampled_from([0, 1, None])),
                    min_size=0, max_size=12))
def test_enrich_matches_model(spark, feed, ref):
    f = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(feed)], "A string, B bigint, i int")
    r = spark.createDataFrame(ref, "A string, B bigint, T double, O int")
    got = sorted((row["i"], row["T"], row["m"]) for row in enrich(f, r, SPEC, flag="m").collect())
    assert got == model([(a, b, i) for i, (a, b) in enumerate(feed)], ref)
