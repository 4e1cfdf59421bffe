import re

from fleetstream.plans import run_report, views
from fleetstream.sources.bucketed_runs import land_runs, large_runs

SF = "/root/testdata/sf0.001"


def facts_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def executed(df):
    """The physical plan before adaptive changes, and the changes it allows."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_facts_need_no_exchange(spark):
    runs = views.run_orders(spark, SF)
    lines, samples = views.run_lines_of(runs), views.run_samples_of(runs)
    landed = land_runs(lines, samples, 4)
    assert not landed.has_large
    found = landed.report(spark, run_report.run_facts)
    plan = executed(found)
    # A small side may be sent instead of joined bucket by bucket; no line is exchanged.
    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
    assert facts_of(found) == facts_of(run_report.run_facts(lines, samples))
    # Landed once, reported again: sums and counts of whole tables agree too.
    assert landed.lines.bucketed(spark).count() == lines.count()
    assert not re.search("Exchange hash", executed(run_report.log_facts(landed.lines.bucketed(spark))))
    landed.drop(spark)


def test_large_runs_are_kept_apart(spark):
    runs = views.run_orders(spark, SF)
    lines, samples = views.run_lines_of(runs), views.run_samples_of(runs)
    one = lines.agg({"run_id": "min"}).first()[0]
    # A run with half of all lines, and a repeated line of a run without an id.
    more = lines.selectExpr(f"'{one}' AS run_id", "'notes.txt' AS file_name", "line_no", "value")
    odd = lines.where("file_name = 'timing.log'").orderBy("run_id", "line_no").limit(1)
    odd = odd.selectExpr("CAST(null AS string) AS run_id", "file_name", "line_no", "value")
    lines = lines.unionByName(more).unionByName(odd).unionByName(odd)
    landed = land_runs(lines, samples, 4)
    assert landed.has_large
    assert [r["run_id"] for r in large_runs([lines, samples], 4).collect()] == [one]
    large = landed.lines.large(spark)
    assert {r["run_id"] for r in large.select("run_id").distinct().collect()} == {one}
    assert large.count() + landed.lines.bucketed(spark).count() == lines.count()
    assert landed.lines.bucketed(spark).where("run_id IS NULL").count() == 2
    found = landed.report(spark, run_report.run_facts)
    assert facts_of(found) == facts_of(run_report.run_facts(lines, samples))
    landed.drop(spark)


def test_empty_landing(spark):
    runs = views.run_orders(spark, SF).where("false")
    landed = land_runs(views.run_lines_of(runs), views.run_samples_of(runs), 4)
    assert not landed.has_large and landed.report(spark, run_report.run_facts).count() == 0
    landed.drop(spark)
