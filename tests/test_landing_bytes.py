"""What the jobs write and shuffle beside their tables: the delimited landing, and the counts of titles."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from circulation import schemas
from circulation.operators import dyadic
from circulation.plans import jobs
from circulation.session import scratch_path
from circulation.sinks import Warehouse

from conftest import plan_text


def _warehouse(spark):
    return Warehouse(spark, f"circ_land_{uuid.uuid4().hex[:10]}", scratch_path(spark, "land"))


def test_landed_files_are_compressed_and_give_the_same_rows(spark, tmp_path):
    texts = ["t|u", 'say "x"\nand y', " b ", "plain", "", "last"]
    rows = [tuple(i if f.dataType.typeName() != "string" else texts[(i + k) % 6] for k, f in enumerate(schemas.STAGING_LOANS.fields))
            for i in range(500)]
    df = spark.createDataFrame(rows, schemas.STAGING_LOANS)
    wh = _warehouse(spark)
    landed = jobs._land(wh, df, str(tmp_path), "loans", "2018-05-31", schemas.STAGING_LOANS)
    assert sorted(map(tuple, landed.collect()), key=repr) == sorted(map(tuple, df.fillna("").collect()), key=repr)
    files = [f for f in os.listdir(tmp_path / "loans" / "run_date=2018-05-31") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_node_sums_add_up_rows_of_one_key_and_day(spark):
    day = dt.date(2018, 5, 2)
    data = [("a", day, 2), ("a", day, 3), ("a", None, 1), ("a", None, 4), (None, day, 7), ("a", day + dt.timedelta(days=1), 5)]
    got = dyadic.node_sums(spark.createDataFrame(data, "k string, day date, n long"), ["k"], "n", 2).collect()
    found = {(r["k"], r["level"], r["node"]): r["n"] for r in got}
    first = dyadic.day_number(day)
    assert len(found) == len(got)
    assert found[("a", 0, first)] == 5 and found[("a", -1, 0)] == 5 and found[(None, 0, first)] == 7
    assert found[("a", 12, first >> 12)] == 10


def test_titles_are_shuffled_once_after_their_books_are_found(spark, monkeypatch):
    plans, concrete = [], type(spark.range(1))
    sort = concrete.sortWithinPartitions

    def seen(self, *cols, **kwargs):
        out = sort(self, *cols, **kwargs)
        if "level" in out.columns and "title" in out.columns:
            plans.append(plan_text(out))
        return out

    monkeypatch.setattr(concrete, "sortWithinPartitions", seen)
    wh = _warehouse(spark)
    wh.append("dim_books", spark.createDataFrame([(1, "T", "p", "a"), (2, "T", "p", "a")], schemas.DIM_BOOKS))
    facts = [(f"x{i}", dt.datetime(2018, 5, 1 + i % 9), "t", "c", i % 3, f"g{i % 2}") for i in range(30)]
    wh.replace_run("2018-05-31", spark.createDataFrame(facts, schemas.FACT_LOANS))
    (text,) = plans
    assert text[:text.index("Join")].count("Exchange") == 1, text


def test_files_of_all_parts_are_written_with_the_stronger_codec(spark):
    """Tables, bucketed tables, facts and nodes: a third less is written than with the session's codec."""
    wh = _warehouse(spark)
    wh.append("dim_books", spark.createDataFrame([(1, "T", "p", "a"), (2, "T", "p", "a")], schemas.DIM_BOOKS))
    facts = [(f"x{i}", dt.datetime(2018, 5, 1 + i % 9), "t", "c", i % 3, f"g{i % 2}") for i in range(30)]
    wh.replace_run("2018-05-31", spark.createDataFrame(facts, schemas.FACT_LOANS))
    found = {}
    for folder, _, names in os.walk(wh.location.removeprefix("file:")):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(folder.split("/tables/")[1].split("/")[0].split("_parts")[0], []).append(name)
    assert set(found) == {"dim_books", "fact_loans", "fact_load_days", "fact_group_nodes", "fact_title_nodes"}
    assert all(".zstd" in name for names in found.values() for name in names), found
