"""Every query by name: a function of the bound tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from floorlens.operators import features, quality, views
from floorlens.operators.reports import executive, health, location, machine, player
from floorlens.plans import scored, trained
from floorlens.sources.bind import Floor

Query = Callable[[Floor], DataFrame]

VIEWS: dict[str, Query] = {
    "v1_machine_daily": views.machine_daily,
    "v2_location_performance": views.location_performance,
    "v3_player_summary": views.player_summary,
    "v4_machine_health": views.machine_health,
    "v5_executive_kpis": views.executive_kpis,
}

FEATURES: dict[str, Query] = {
    "f1_player_churn": features.player_churn,
    "f2_machine_failure": features.machine_failure,
    "f3_daily_forecast": features.daily_forecast,
    "f4_machine_anomaly": features.machine_anomaly,
    "f5_weekly_forecast": features.weekly_forecast,
}

REPORTS: dict[str, Query] = {
    "m1_machine_summary": machine.machine_revenue_summary,
    "m2_top_machines": machine.top_machines,
    "m3_bottom_machines": machine.bottom_machines,
    "m4_machine_ranking": machine.machine_ranking,
    "m5_by_manufacturer": machine.by_manufacturer,
    "m6_by_game_category": machine.by_game_category,
    "m7_highest_downtime": machine.highest_downtime,
    "m8_lowest_availability": machine.lowest_availability,
    "m9_revenue_per_available_hour": machine.revenue_per_available_hour,
    "m10_daily_trend": machine.daily_trend,
    "m11_seven_day_average": machine.seven_day_average,
    "m12_day_over_day": machine.day_over_day,
    "m13_by_software_version": machine.by_software_version,
    "m14_investigation_list": machine.investigation_list,
    "m15_best_worst_machine": machine.best_worst_machine_per_location,
    "p1_player_kpis": player.kpis,
    "p2_by_loyalty_tier": player.by_loyalty_tier,
    "p3_top_by_revenue": player.top_by_revenue,
    "p4_top_by_wager": player.top_by_wager,
    "p5_player_ranking": player.ranking,
    "p6_value_segmentation": player.value_segmentation,
    "p7_rfm": player.rfm,
    "p8_churn_tiers": player.churn_tiers,
    "p9_churn_summary": player.churn_summary,
    "p10_session_frequency": player.session_frequency,
    "p11_mobility": player.mobility,
    "p12_preferred_location": player.preferred_location,
    "p13_preferred_machine": player.preferred_machine,
    "p14_weekend_vs_weekday": player.weekend_vs_weekday,
    "p15_time_of_day": player.time_of_day,
    "p16_monthly_activity": player.monthly_activity,
    "p17_cohort_retention": player.cohort_retention,
    "p18_lifetime_value": player.lifetime_value,
    "p19_opt_in_comparison": player.opt_in_comparison,
    "p20_rfm_export": player.rfm_export,
    "l1_location_overall": location.overall,
    "l2_location_ranking": location.ranking,
    "l3_contribution": location.contribution,
    "l4_productivity": location.productivity,
    "l5_by_region": location.by_region,
    "l6_by_location_type": location.by_location_type,
    "l7_daily_trend": location.daily_trend,
    "l8_monthly": location.monthly,
    "l9_three_month_average": location.three_month_average,
    "l10_best_worst_location": location.best_worst_per_region,
    "l11_machine_mix": location.machine_mix,
    "l12_player_mobility": location.player_mobility,
    "l13_operational_risk": location.operational_risk,
    "l14_revenue_and_downtime": location.revenue_and_downtime,
    "l15_quadrants": location.quadrants,
    "h1_fleet_summary": health.fleet_summary,
    "h2_health_ranking": health.ranking,
    "h3_top_downtime": health.top_downtime,
    "h4_top_critical": health.top_critical,
    "h5_event_distribution": health.event_distribution,
    "h6_root_causes": health.root_causes,
    "h7_mttr": health.mean_time_to_repair,
    "h8_mtbf": health.mean_time_between_failures,
    "h9_reliability": health.reliability,
    "h10_by_manufacturer": health.by_manufacturer,
    "h11_by_software_version": health.by_software_version,
    "h12_daily_downtime": health.daily_downtime,
    "h13_repeat_failures": health.repeat_failures,
    "h14_maintenance_priority": health.maintenance_priority,
    "h15_replacement": health.replacement_candidates,
    "h16_health_export": health.health_export,
    "e1_executive_kpis": executive.kpi_summary,
    "e2_daily_trend": executive.daily_trend,
    "e3_monthly_performance": executive.monthly_performance,
    "e4_top_bottom_locations": executive.top_and_bottom_locations,
    "e5_top_machines": executive.top_machines,
    "e6_player_segments": executive.player_segments,
    "e7_churn_summary": executive.churn_summary,
    "e8_health_summary": executive.health_summary,
    "e9_revenue_vs_downtime": executive.revenue_vs_downtime,
    "e10_manufacturers": executive.manufacturers,
    "e11_software_versions": executive.software_versions,
    "e12_master_dataset": executive.master_dataset,
}

QUALITY: dict[str, Query] = {
    "q1_primary_keys": quality.primary_keys,
    "q2_orphans": quality.orphans,
    "q3_location_agreement": quality.location_agreement,
    "q4_negative_amounts": quality.negative_amounts,
    "q5_revenue_arithmetic": quality.revenue_arithmetic,
    "q6_reconciliation": quality.revenue_reconciliation,
    "q7_timestamps": quality.timestamps,
    "q8_summary": quality.summary,
    "q9_relationship_agreement": quality.relationship_agreement,
    "q10_severity_domain": quality.severity_domain,
    "q11_completeness": quality.completeness,
    "q12_declared_constraints": quality.declared_constraints,
}


def all_queries() -> dict[str, Query]:
    return {**VIEWS, **FEATURES, **REPORTS, **QUALITY, **scored.ML, **scored.LOOKUPS, **trained.TRAINED}
