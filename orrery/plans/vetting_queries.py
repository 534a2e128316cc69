"""Full vetting, and recall by injected events, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.operators import survey, vetting
from orrery.operators.relational import union_all
from orrery.plans.base import Registry

R = Registry()

NUMBERS = (
    "share_dropped", "span", "max_offset", "max_scatter_ratio", "min_scatter_ratio", "period", "duration", "t0", "depth", "depth_err", "snr", "share_bright", "share_in_near_gap", "share_near_gap", "robust_depth", "robust_sigma", "depth_ratio",
    "depth_odd", "depth_even", "odd_even_z", "second_phase", "second_depth", "second_sigma",
)


@R.add(rounded=NUMBERS)
def vetted_objects(t):
    """Every group's verdict, gates and measures by the whole grid of the search."""
    return vetting.vetted(t.curves, "g")


@R.add(rounded=("rate", "lo", "hi"))
def injection_recall(t):
    """Six hosts that fail the gates, four injected and two shuffled series each: recall by period and depth, outcomes, and
    the rate of false alarms."""
    judged = vetting.vetted(t.curves, "g")
    hosts = vetting.injection_hosts(judged, "g", "n_points", 2, 6, 20261108).select("g")
    found = vetting.written(vetting.injection_results(t.curves, hosts, "g", 4, 2), "injection-results")
    injected, shuffled = found.filter("kind = 'inject' AND searchable"), found.filter("kind = 'shuffle'")
    by = {"period": F.when(F.col("period") < 2, "<2 d").when(F.col("period") < 5, "2-5 d").otherwise(">5 d"), "depth": F.when(F.col("depth") < 0.02, "<2%").when(F.col("depth") < 0.1, "2-10%").otherwise(">10%"), "outcome": F.col("outcome"), "status": F.col("status")}
    recall = survey.recall_by(injected, by, F.col("outcome").isin("exact", "alias")).withColumn("kind", F.lit("recall"))
    alarms = survey.recall_by(shuffled, {"status": F.col("status")}, F.col("outcome") == "pass").withColumn("kind", F.lit("false alarm"))
    return union_all([recall, alarms])
