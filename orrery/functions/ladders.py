"""Precedence-ordered classifications: the first rule that holds decides, and an unknown answer never counts as one.

The outcome names and thresholds are fixed values of the domain's published rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.scalars import col, ladder


def yes(x) -> Column:
    return F.coalesce(col(x), F.lit(False))


def novelty_verdict(known_eb, known_ell, toi, known_other, contaminated) -> Column:
    return ladder((yes(known_eb), "KNOWN_EB"), (yes(known_ell), "KNOWN_ELLIPSOIDAL"), (yes(toi), "KNOWN_TOI"), (yes(known_other), "KNOWN_OTHER_TYPE"), (yes(contaminated), "CONTAMINATED"), otherwise="NOVEL")


def first_number(sources: list[tuple[str, object]]) -> tuple[Column, Column]:
    """The first source that has a number, and its label."""
    from orrery.functions.scalars import to_double

    values = [(name, to_double(x)) for name, x in sources]
    return F.coalesce(*[v for _, v in values]), F.coalesce(*[F.when(v.isNotNull(), name) for name, v in values])


def blend_status(failed, matched, n_capable) -> Column:
    return ladder((yes(failed), "QUERY_FAILED"), (yes(matched), "LIKELY_CONTAMINATION"), (col(n_capable) == 0, "BLEND_RULED_OUT"), otherwise="BLEND_POSSIBLE")


def pixel_verdict(snr, compactness, offset, nearest_capable, least_snr=5.0, least_compactness=0.3, most_offset=1.0) -> Column:
    """Null where the image can't locate the source."""
    return ladder(
        (col(snr) < least_snr, None), (col(compactness) < least_compactness, None), (col(offset) > most_offset, "OFF_TARGET"), (col(nearest_capable) <= col(offset), "UNRESOLVED"), otherwise="ON_TARGET"
    )


def neighbour_status(viable, unseparable) -> Column:
    return ladder((col(viable) == 0, "NO_VIABLE_NEIGHBOUR"), (col(unseparable) > 0, "UNSEPARABLE_NEIGHBOUR"), otherwise="VIABLE_NEIGHBOUR_AT_OFFSET")


def independent_verdict(p_value, n_events, snr, ratio, ratio_error, power, most_p=0.01, least_events=3, span=(0.4, 1.6), testable=0.9) -> Column:
    consistent = (col(ratio) + 2 * col(ratio_error) >= span[0]) & (col(ratio) - 2 * col(ratio_error) <= span[1])
    confirmed = (col(p_value) <= most_p) & (col(n_events) >= least_events) & (col(snr) > 0) & consistent
    return ladder((col(power).isNull(), "NO_DATA"), (confirmed, "CONFIRMED"), (col(power) >= testable, "NOT_SEEN"), otherwise="INCONCLUSIVE")


def evidence_tier(lines, against, caveats) -> Column:
    """From three arrays of reasons."""
    return ladder((F.size(col(against)) > 0, "DISFAVOURED"), (F.size(col(lines)) > 0, "INDEPENDENTLY_SUPPORTED"), (F.size(col(caveats)) == 0, "TESS_ONLY_CLEAN"), otherwise="TESS_ONLY_CAVEATS")


def reasons(*pairs: tuple) -> Column:
    """The texts whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(yes(c), F.lit(t) if isinstance(t, str) else t) for c, t in pairs]))


def novelty_label(catalog_match, listed_eclipsing, orbit_relation, listed_binary, listed_variable) -> Column:
    return ladder((yes(catalog_match) | yes(listed_eclipsing), "KNOWN_ECLIPSING"), (col(orbit_relation).isin("same", "half", "double") | yes(listed_binary), "KNOWN_BINARY"), (yes(listed_variable), "KNOWN_VARIABLE"), otherwise="NO_PRIOR_FOUND")


def submission_wave(tier, status, novelty, n_caveats) -> Column:
    return ladder(
        ((col(tier) != "INDEPENDENTLY_SUPPORTED") | (col(status) != "CONFIRMED"), None),
        ((col(novelty) == "NO_PRIOR_FOUND") & (col(n_caveats) == 0), "wave1"), (col(novelty) == "NO_PRIOR_FOUND", "wave2"), (col(novelty) == "KNOWN_VARIABLE", "existing"),
    )


def catalog_outcome(covered, n_rows, n_same, same_has_period, match) -> Column:
    """One star in one catalog. covered is true, false or unknown (null); match says whether a period agrees."""
    same, any_ = col(n_same) > 0, col(n_rows) > 0
    return ladder(
        (~col(covered), "NOT_COVERED"), (~any_, "NO_MATCH"), (same & yes(match), "SAME_STAR_PERIOD_MATCH"), (same & yes(same_has_period), "SAME_STAR_OTHER_PERIOD"),
        (same, "SAME_STAR_NO_PERIOD"), (yes(match), "NEARBY_PERIOD_MATCH"), otherwise="NEARBY_OTHER",
    )


def star_verdict(statuses, covered_no_match) -> Column:
    """Over the catalogs' outcomes: what is positive counts though a catalog failed; a failure blocks NO_MATCH."""
    has = lambda *names: F.arrays_overlap(col(statuses), F.array(*map(F.lit, names)))
    return ladder(
        (has("SAME_STAR_PERIOD_MATCH"), "ALREADY_KNOWN"), (has("SAME_STAR_OTHER_PERIOD", "SAME_STAR_NO_PERIOD"), "KNOWN_VARIABLE_PERIOD_DIFFERS"), (has("NEARBY_PERIOD_MATCH"), "NEARBY_PERIOD_MATCH"),
        (has("NEARBY_OTHER"), "NEARBY_VARIABLE"), (has("QUERY_FAILED"), "INCOMPLETE"), (yes(covered_no_match), "NO_MATCH"), (has("NO_MATCH"), "NO_MATCH_WEAK"), otherwise="NOT_COVERED",
    )


def graded_outcome(covered, predicted, predicted_sigma_min, measured, measured_sigma_min, source, systematic_min=10.0, sigmas=3.0) -> Column:
    noisy = F.upper(F.coalesce(col(source), F.lit(""))) == "QLP"
    sigma = F.sqrt(F.pow(col(predicted_sigma_min), 2) + F.pow(col(measured_sigma_min), 2) + F.when(noisy, systematic_min**2).otherwise(0.0))
    missing = ~yes(covered) | col(measured).isNull() | col(measured_sigma_min).isNull() | F.coalesce(col(measured_sigma_min) < 0, F.lit(True))
    return ladder((missing, "INSUFFICIENT_DATA"), (F.abs((col(measured) - col(predicted)) * 1440.0) <= sigmas * sigma, "RECOVERED"), otherwise="INCONSISTENT")


def holdout_status(least_p, n_tests, alpha=0.01) -> Column:
    """Bonferroni over the held-out parts."""
    return ladder((col(n_tests) == 0, "NO_TEST"), (col(least_p) < alpha / col(n_tests), "FAIL"), otherwise="PASS")


def prediction_grade(status, horizon_days, tested_days, most_factor=3.0) -> Column:
    return ladder(
        (col(status) == "FAIL", "REJECTED"), (col(status) != "PASS", "UNVALIDATED"), (col(horizon_days).isNull() | (col(tested_days) <= 0), "UNVALIDATED"),
        (col(horizon_days) / col(tested_days) <= most_factor, "VALIDATED"), otherwise="UNVALIDATED",
    )


def eligibility(tier, has_detail, aliased, n_absent, n_checks) -> Column:
    """'' where fit, else the first reason why not."""
    return ladder(
        (~(col(tier).eqNullSafe(F.lit("CLEAN"))), F.concat(F.lit("TIER_"), F.replace(F.coalesce(col(tier), F.lit("None")), F.lit(" "), F.lit("_")))),
        (~yes(has_detail), "NO_DETAIL_FILE"), (yes(aliased), "PERIOD_ALIAS"), (col(n_absent) > 0, "PREDICTED_ECLIPSE_MISSING"), (col(n_checks) > 0, "PIPELINE_CHECK_FLAGGED"), otherwise="",
    )


def literature_verdict(n_objects, n_references, n_survey) -> Column:
    return ladder(
        (col(n_objects) == 0, "NOT_IN_SIMBAD"), (col(n_references) == 0, "IN_SIMBAD_NO_REFERENCES"), (col(n_survey) == col(n_references), "IN_SIMBAD_SURVEY_PAPERS_ONLY"), otherwise="IN_SIMBAD_WITH_STUDIES"
    )


def velocity_decision(n, delta_chi2, companion, depth_ratio, depth, moves=25.0, still=9.0, substellar=0.08, deep=0.05) -> Column:
    tight = (col(delta_chi2) <= still) & (col(companion) < substellar)
    return ladder(
        (col(n) < 5, "INCONCLUSIVE"), (col(delta_chi2) >= moves, "MOVES"), (tight & (col(depth_ratio) >= 0.5), "STATIC_OR_TWIN"), (tight & (col(depth) >= deep), "BLEND_INDICATED"),
        (tight, "SUBSTELLAR_OR_BLEND"), otherwise="INCONCLUSIVE",
    )


def photometry_decision(z, p_value, expected_z, depth, sigma, expected, support_z=3.0, support_p=0.01, power_z=5.0, absent=0.25) -> Column:
    return ladder(
        (col(depth).isNull(), "INCONCLUSIVE"), ((col(z) >= support_z) & (col(p_value) <= support_p), "SUPPORTED"),
        ((col(expected_z) >= power_z) & (col(depth) + 3 * col(sigma) < absent * col(expected)), "CONTRADICTED"), otherwise="INCONCLUSIVE",
    )


def surface_gates(a_ell, err_ell, b_ell, a_ref, err_ref, sinusoidal, least_snr=5.0, most=0.2) -> tuple[Column, Column]:
    """(tides, heating)."""
    ok = ~yes(sinusoidal)
    tides = ok & (col(a_ell) > 0) & (col(a_ell) / col(err_ell) >= least_snr) & (F.abs(col(b_ell)) <= 0.5 * col(a_ell)) & (col(a_ell) <= most)
    heating = ok & (col(a_ref) > 0) & (col(a_ref) / col(err_ref) >= least_snr) & (col(a_ref) <= most)
    return F.coalesce(tides, F.lit(False)), F.coalesce(heating, F.lit(False))


def fit_trusted(radius_sum, verdict, ecosw_fit, ecosw_other, sigma) -> Column:
    near = F.abs(col(ecosw_fit) - col(ecosw_other)) <= F.greatest(3.0 * F.coalesce(col(sigma), F.lit(0.0)), F.lit(0.01))
    return F.coalesce((col(radius_sum) <= 0.25) & col(verdict).isin("ECCENTRIC", "CIRCULAR_WITHIN_ERRORS") & near, F.lit(False))


def variable_group(otype, eclipsing: list[str], other: list[str]) -> Column:
    """Group of an object type by lists, then by its ending."""
    t = F.coalesce(col(otype), F.lit(""))
    return ladder((t == "", "none"), (t.isin(eclipsing), "eclipsing_binary"), (t.isin(other) | F.endswith(t, F.lit("*")) & F.startswith(t, F.lit("V")), "other_variable_or_peculiar"), otherwise="star")


def reference_kind(title, survey: str, study: str) -> Column:
    """survey, study or mid, by two patterns."""
    t = F.coalesce(col(title), F.lit(""))
    return ladder((F.rlike(t, F.lit(f"(?i){study}")), "study"), (F.rlike(t, F.lit(f"(?i){survey}")), "survey"), otherwise="mid")


def rv_variability(velocity, p_value) -> Column:
    """True or false where there is a statistic, else null: no answer is not 'constant'."""
    return F.when(col(velocity).isNull() | col(p_value).isNull(), F.lit(None).cast("boolean")).otherwise(col(p_value) < 0.01)


def footprint(dec, low=None, high=None, known: bool = True) -> Column:
    """Whether a survey covers a declination: true, false, or null where its footprint is not known."""
    if not known:
        return F.lit(None).cast("boolean")
    inside = F.lit(True)
    inside = inside & (col(dec) >= low) if low is not None else inside
    return inside & (col(dec) <= high) if high is not None else inside
