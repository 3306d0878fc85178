"""Print the physical plan trees of the headline operators (formatted explain,
tree part only) as Markdown. usage: python tools/show_plans.py [sf_dir]"""
import io
import os
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from keystitch import enrich, fixtures as X  # noqa: E402
from keystitch.catalog import QUERIES  # noqa: E402
from keystitch.session import local_session  # noqa: E402


def tree(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    lines = text.split("\n\n")[0].splitlines()
    details = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
    return "\n".join(lines + [""] + details)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    feed, ref = X.x1_feed(spark, sf), X.x1_reference(spark, sf)
    small = X.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("Airline PNR"), F.col("n_regionkey").alias("Airline Code"),
        F.substring("n_name", 1, 1).alias("Sector"))
    cases = [
        ("enrich_first_match (feed and reference of similar size)", enrich(feed, ref, X.x1_spec(ref))),
        ("small feed against the same reference (measured broadcast semi-join before the window)",
         enrich(small, ref, X.x1_spec(ref))),
        ("first_per_key", QUERIES["first_per_key"](spark, sf)),
        ("match_stats", QUERIES["match_stats"](spark, sf)),
        ("unmatched_rows (keys only, no ranking)", QUERIES["unmatched_rows"](spark, sf)),
        ("sheet_union (feed and reference read once)", QUERIES["sheet_union"](spark, sf)),
        ("sheets_info", QUERIES["sheets_info"](spark, sf)),
    ]
    print(f"# Physical plans ({sf}, local[8], shuffle partitions 16, AQE on)\n")
    print("Generated by `python tools/show_plans.py`. Initial adaptive plans; AQE may still switch a "
          "sort-merge join to broadcast from measured sizes at run time.\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
