"""The questions as SQL functions: same rows and order as the DataFrame forms, whatever arguments are given."""

import pytest

from hourmeter.operators import quality as QL
from hourmeter.operators import rankings as RK
from hourmeter.operators import views as V
from hourmeter.plans import contract as C
from hourmeter.plans import snapshot as SN
from hourmeter.plans.sql_functions import register_functions

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark):
    from hourmeter.operators.intervals import interval_days
    from hourmeter.operators.views import event_days

    t = C.facade_loaded(spark, SF)
    t = t.with_(events=t.events.checkpoint(), rejected_rows=t.rejected_rows.checkpoint(), source_files=t.source_files.checkpoint())
    t = t.with_(interval_days=interval_days(t).checkpoint(), event_days=event_days(t).checkpoint())
    register_functions(spark, t)
    return t


def rows(df, drop=()):
    return [tuple(r[c] for c in df.columns if c not in drop) for r in df.collect()]


CASES = [
    ("machine_run_hours()", lambda t: RK.machine_run_hours(t)),
    ("machine_run_hours(DATE '2024-01-10', NULL, 'reach trucks', '  ', '')", lambda t: RK.machine_run_hours(t, "2024-01-10", None, "reach trucks", "  ", "")),
    ("machine_run_hours(machine_type => 'submarine')", lambda t: RK.machine_run_hours(t, machine_type="submarine")),
    ("machine_run_hours(ref_no => ' m000007 ')", lambda t: RK.machine_run_hours(t, ref_no=" m000007 ")),
    ("driver_activity(event_type => 'SPEEDING')", lambda t: RK.driver_activity(t, event_type="SPEEDING")),
    ("driver_activity(branch => 'asia', driver_name => 'SUPPLIER 1')", lambda t: RK.driver_activity(t, branch="asia", driver_name="SUPPLIER 1")),
    ("branch_summary(date_to => DATE '2024-01-09')", lambda t: RK.branch_summary(t, None, "2024-01-09")),
    ("machine_events(event_type => 'login', machine_type => 'ppt')", lambda t: RK.machine_events(t, event_type="login", machine_type="ppt")),
    ("machine_events(date_from => DATE '2030-01-01')", lambda t: RK.machine_events(t, "2030-01-01")),
    ("data_coverage()", lambda t: V.data_coverage(t)),
    ("data_quality()", lambda t: QL.data_quality(t)),
    ("data_quality_summary()", lambda t: QL.data_quality_summary(t)),
]


@pytest.mark.parametrize("call, question", CASES, ids=[c for c, _ in CASES])
def test_function_equals_question(spark, loaded, call, question):
    got, want = spark.sql(f"SELECT * FROM {call}"), question(loaded)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_dashboard_document_equals_the_snapshot(spark, loaded):
    import json

    for call, period in (("dashboard_snapshot(DATE '2024-01-08', DATE '2024-01-14')", ("2024-01-08", "2024-01-14")), ("dashboard_snapshot()", (None, None))):
        got = json.loads(spark.sql(f"SELECT * FROM {call}").first()[0])
        want = json.loads(SN.dashboard_snapshot(loaded, *period, cache=False).to_json())
        for text in (got, want):
            text.pop("generated_at")
        assert got == want


def test_scalar_functions_and_missing_logs(spark, loaded):
    told = spark.sql("SELECT norm_machine_type('Pallet jack'), norm_machine_type(' '), norm_machine_type('boat'), norm_event_type('hard BRAKING'), norm_event_type(NULL), norm_event_type('x')").first()
    assert tuple(told) == ("PPT", None, "__unknown__", "HARSH_BRAKING", None, "__unknown__")
    units = spark.sql("SELECT hour_units(18, 100), hour_units(17, 100), hour_units(-18, 100), hour_units(NULL, 100)").first()
    assert tuple(units) == (1, 0, -1, None)
    names = register_functions(spark, loaded.with_(ingestion_runs=None, rejected_rows=None))
    assert "machine_events" in names and "data_quality" not in names
    register_functions(spark, loaded)


def test_a_constant_date_reaches_the_stored_rollup(spark, tmp_path):
    from hourmeter.plans.store import Store, materialize

    store = Store(spark, str(tmp_path / "w"))
    materialize(store, C.facade_tables(spark, SF), load_id="x")
    register_functions(spark, store.tables())
    plan = spark.sql("SELECT * FROM machine_run_hours(date_from => DATE '2024-01-29')")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and ">= 2024-01-29" in plan
