"""Plan shape of the flagship: native expressions, no range exchange, filters pushed."""

from fixtures import COLS, write_city
from strata.plans import catalog
from strata.plans.job import necessary, transform
from strata.sources.records import read_tagged

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = catalog.q_flagship(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
    assert "rangepartitioning" not in plan.lower()
    # the copy count and the two nest levels shuffle; dimensions are broadcast
    final = plan.split("== Initial Plan ==")[0]  # AQE prints the final plan, then the initial one
    assert final.count("Exchange hashpartitioning") == 3
    # parquet scans read only the columns used
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "l_comment" not in opt


def test_csv_filters_pushed(spark, tmp_dir):
    """In the default mode the filters are in the scan, and no Python runs above it."""
    p = write_city(tmp_dir)
    for mode in ("positional", "typed", "none"):
        df = transform(read_tagged(spark, {p: "台北市"}, require=COLS, alias_row=mode, where=necessary()), max_events_per_line=None)
        plan = _plan(df)
        pushed = plan.split("PushedFilters: ")[1].split("]")[0]
        assert "StringContains" in pushed and "EqualTo" in pushed
        assert "Python" not in plan and "MapIn" not in plan


def test_only_files_whose_first_row_passes_are_cut(spark, tmp_dir):
    a, b = write_city(tmp_dir, "A"), write_city(tmp_dir, "B", alias=None)
    plan = _plan(read_tagged(spark, {a: "台北市", b: "台中市"}, require=COLS, where=necessary()))
    assert plan.count("FileScan csv") == 2 and plan.count("MapInArrow") == 1


def test_paged_plan_broadcasts_offsets(spark):
    df = catalog.q_nest_paged(spark, SF)
    df.collect()
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "EvalPython" not in plan


def test_direct_flagship_has_one_shuffle_per_level(spark):
    df = catalog.q_flagship_direct(spark, SF)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 2


def test_positional_mode_reads_only_needed_columns(spark, tmp_dir):
    p = write_city(tmp_dir)
    plan = _plan(read_tagged(spark, {p: "台北市"}, require=["備註"]).select("備註"))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "備註" in schema and "交易年月日" not in schema
