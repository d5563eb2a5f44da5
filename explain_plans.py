"""Write PLANS.md: the final (adaptive) physical plans of the key operators, with what to look for.

    python explain_plans.py [sf_dir]

The warehouse is built with the real jobs; plans are taken after each query ran, so they show
what AQE chose. A second set is planned with broadcasting off, as when lookup sides are too big.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from circulation.plans import fixtures as fx  # noqa: E402
from circulation.plans import jobs, marts, model  # noqa: E402
from circulation.session import build_session, scratch_path  # noqa: E402
from circulation.sinks import CANONICAL, Warehouse  # noqa: E402
from circulation.operators import assign_ids  # noqa: E402
from circulation.sources import extract_window  # noqa: E402

RUNS = (("1900-01-01", "1998-06-30"), ("1998-06-30", "2100-01-01"))
LO, HI = "1998-01-01", "1998-03-31"


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    wh = Warehouse(spark, f"circ_plans_{uuid.uuid4().hex[:10]}", scratch_path(spark, "plans"))
    inventory, codes, loans = fx.inventory_source(spark, sf_dir), fx.codes(spark, sf_dir), fx.loans(spark, sf_dir)
    for lo, hi in RUNS:
        jobs.run_monthly(wh, inventory, codes, lo, hi)
        jobs.run_daily(wh, loans, lo, hi)
    fact, days = wh.scan("fact_loans"), wh.load_days()

    sections: list[tuple[str, str, object]] = [
        ("Window extract on a typed timestamp (S2, S3)",
         "`PushedFilters` carry `(lo, hi]`; `ReadSchema` holds only the projected columns.",
         lambda: extract_window(fx.read_table(spark, sf_dir, "events"), "ts", "2024-01-08", "2024-01-22",
                                ["event_id", "ts"])),
        ("First row per book (W2)",
         "`WindowGroupLimit ... Partial` sits below the `Exchange`: each map task forwards one row per book, "
         "so a book holding a third of the inventory costs one row per task in the shuffle.",
         lambda: model.canonical_inventory(wh.scan("staging_inventory"))),
        ("Surrogate ids (I1)",
         "One `Exchange SinglePartition`, over one row per partition of the new members and one per partition "
         "of the existing ids. The written range-partitioned members join the offsets by broadcast.",
         lambda: assign_ids(wh.scan("dim_subject").select("subject"), "subject", "subject_id", wh.scan("dim_subject"))),
        ("New books (C5): anti join against the bucketed table",
         "`dim_books` is read bucketed by `bibnum`; only the canonical inventory is shuffled.",
         lambda: model.new_dim_books(wh.scan(CANONICAL), wh.scan("dim_books"))),
        ("Loans per day (C9)",
         "Calendar ends and per-day counts come from `fact_load_days`; the fact is not scanned.",
         lambda: marts.loans_per_day(fact, LO, HI, days)),
        ("Top subjects (C10)",
         "The fact is counted per group (`partial_count` below the first join) before meeting the bridge; "
         "`TakeOrderedAndProject` keeps k rows per task.",
         lambda: marts.popular_subjects(fact, wh.scan("bridge_subject"), wh.scan("dim_subject"), LO, HI, days=days)),
        ("Top titles (C11)",
         "Counted per book before the lookup of titles.",
         lambda: marts.popular_titles(fact, wh.scan("dim_books"), LO, HI, days=days)),
        ("One-pass refresh: counts per group and book",
         "One fact scan over the partitions that the range can lie in, partial aggregate, one `Exchange`; the result "
         "(about one row per book) is written and both top lists read it.",
         lambda: marts.range_counts(fact, LO, HI, days)),
    ]
    big_sections: list[tuple[str, str, object]] = [
        ("Fact load (C7) when the canonical inventory is over the broadcast bound",
         "Both sides are shuffled on the book, so AQE can split a book that holds a large share of the loans "
         "(`tests/test_plans_scale.py` sees the split on the stored table).",
         lambda: model.fact_rows(extract_window(loans, "checkoutdatetime", "1998-03-01", "1998-03-31"),
                                 wh.scan(CANONICAL))),
        ("Top subjects (C10) with broadcasting off",
         "The bridge is read bucketed by `subject_group_id`; only the per-group counts are shuffled.",
         lambda: marts.popular_subjects(fact, wh.scan("bridge_subject"), wh.scan("dim_subject"), LO, HI)),
    ]

    out = ["# PLANS — final physical plans of the key operators",
           "",
           f"Generated by `python explain_plans.py {sf_dir}` on local[8] (AQE on, static broadcast off).",
           "Plans are the final adaptive plans after the query ran.",
           ""]
    for title, note, build in sections:
        out += [f"## {title}", "", note, "", "```", final_plan(build()), "```", ""]

    keys = ("spark.sql.adaptive.autoBroadcastJoinThreshold",)
    saved = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for title, note, build in big_sections:
            out += [f"## {title}", "", note, "", "```", final_plan(build()), "```", ""]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)

    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print("wrote", path)
    spark.stop()


if __name__ == "__main__":
    main()
