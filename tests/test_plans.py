"""Plan guards: no registered query plans a nested-loop or cartesian join,
and pruned scans read only the selected columns."""

import pytest

from ledgerline import registry

from .conftest import SF_MID, SF_SMALL


def explain(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_nested_loop_or_cartesian(spark, name):
    p = explain(registry.queries()[name](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scan_pruned_reads_five_columns(spark):
    p = explain(registry.queries()["q_scan_pruned"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string," \
           "l_shipdate:timestamp_ntz>" in p
    assert "EqualTo(l_returnflag,N)" in p


def test_every_query_cites_survey_ids():
    import re
    for name, fn in registry.queries().items():
        assert re.search(r"\b(SC|SK|PR|FL|JN|AG|DS|WN|SO|SE|ST|CV|NU|DT|MA|AR|JS|MP|CD|SM|PL)\d", fn.__doc__ or ""), name


@pytest.mark.parametrize("name", ["q_line_numbering", "q_header_rollup", "q_scan_pruned", "q_build_events", "q_json_array_docs", "q_cascading_lookup", "q_upsert"])
def test_the_plan_report_is_up_to_date(spark, name):
    from tools import plan_report
    report = open(f"{plan_report.ROOT}/docs/PLANS.md").read()
    assert "\n".join(plan_report.section(spark, name, SF_MID)).strip() in report


def test_retail_events_read_the_sales_once(spark):
    from tools import plan_report
    with plan_report.written_plans() as steps:
        plans = [explain(registry.queries()["q_build_events"](spark, SF_SMALL))]
    reads = [s for p in [*steps, *plans] for s in plan_report.scans(p) if s.startswith("lineitem(")]
    assert len(reads) == 1
