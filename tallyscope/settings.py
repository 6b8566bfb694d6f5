"""Thresholds and fixed vocabulary shared by every job.

All jobs take a ``Thresholds`` value; nothing is read from global state. The
defaults are the production policy; tests and small tables pass smaller floors.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Key sets.
PLAYER = ["parent", "uid"]
CELL = ["game_id", "play_type", "currency", "sm_tag"]
PLAYER_CELL = PLAYER + CELL

# Play types that are feature purchases.
FEATURE_BUY_TYPES = (2, 3, 4)

# Families that never add to a case's independent family count.
NON_CONTRIBUTING_FAMILIES = ("ENVIRONMENT", "MAGNITUDE_WATCH")

# Ordinal scales of the case gate.
ESCALATION_TIER = {"monitor": 1, "watch": 2, "enhanced": 2, "human_review": 3}
SEVERITY_RANK = {"Low": 1, "Medium": 2, "High": 3, "Critical": 4}

# Human decisions that acknowledge a case.
ACKNOWLEDGING_DECISIONS = (
    "dismiss_benign",
    "keep_monitoring",
    "enhanced_monitoring",
    "needs_more_evidence",
    "escalate_to_board",
    "confirmed_for_action",
)

# Metric -> (rule, family, kind, grain).
METRIC_RULES = {
    "buy_share_turnover": ("L1-FEATURE_ROUTING", "ROUTING", "ROBUST", "player"),
    "same_second_share": ("L1-SAME_SECOND", "TIMING", "ROBUST", "player"),
    "modal_share": ("L1-CADENCE_MODE", "TIMING", "ROBUST", "player"),
    "concurrent_rounds": ("L1-CONCURRENT", "INTEGRITY", "ROBUST", "player"),
    "max_rounds_per_minute": ("L1-RATE_CEILING", "TIMING", "ROBUST", "player"),
    "trigger_rate_z": ("L1-TRIGGER_RATE", "OUTCOME_FREQUENCY", "Z", "player_cell"),
    "hit_rate_z": ("L1-HIT_RATE", "OUTCOME_FREQUENCY", "Z", "player_cell"),
    "excess_turnover_z": ("L1-EXCESS_TURNOVER", "OUTCOME_MAGNITUDE", "Z", "player_cell"),
}

# Population segments a calibration is checked on.
SEGMENT_KEYS = ("game_id", "play_type", "currency", "sm_tag", "parent", "volume_group")


@dataclass(frozen=True)
class Thresholds:
    # volume and sessions
    min_rounds: int = 200
    session_idle_s: int = 30 * 60
    gap_cap_s: int = 600
    sequence_bucket: str = "HOUR"
    whole_player_rounds: int = 200_000
    modal_gap_max_s: int = 30
    physical_rpm: int = 120
    hot_session_rounds: int = 30
    hot_session_ratio: float = 2.0
    # balance identity
    balance_abs_tol: float = 0.01
    balance_rel_tol: float = 1e-6
    # calibration
    n_mad: float = 12.0
    mad_min_members: int = 20
    alert_ceiling: float = 0.001
    segment_factor: float = 10.0
    saturation_abort: float = 0.05
    min_segment: int = 50
    # metrics
    peer_min_players: int = 30
    same_second_min_gaps: int = 500
    cadence_min_gaps: int = 1000
    rate_min_rounds: int = 2000
    rate_fdr_q: float = 0.01
    rate_min_lift: float = 2.0
    excess_fdr_q: float = 0.01
    excess_min_points: float = 3.0
    half_window_z: float = 1.645
    # stake foreknowledge
    prescient_min_rounds: int = 2000
    prescient_min_triggers: int = 30
    prescient_fdr_q: float = 0.01
    # magnitude watch
    watch_n_mad: float = 8.0
    watch_min_population: int = 50
    watch_min_rounds: int = 10
    # duty cycle
    duty_min_hours: int = 22
    duty_min_days: int = 7
    duty_max_idle_s: int = 3 * 3600
    # drift
    drift_min_day_rounds: int = 500
    drift_min_days: int = 5
    drift_fdr_q: float = 0.01
    drift_min_points: float = 2.0
    drift_min_lift: float = 2.0
    deploy_min_rounds: int = 5 * 500
    deploy_day_sd: float = 0.02
    deploy_day_rounds: float = 500.0
    deploy_min_z: float = 4.0
    # cohorts
    cohort_min_members: int = 10
    cohort_min_density: float = 0.5
    cohort_min_agreeing: int = 3
    cohort_birth_window_s: int = 60 * 60
    cohort_cv_max: float = 0.05
    cohort_duty_share: float = 0.8
    cohort_corr_min: float = 0.8
    cohort_min_shared_hours: int = 12
    cohort_scale_factor: float = 20.0
    cohort_rtp_spread: float = 0.02
    cohort_null_sigma: float = 1.0
    # unsupervised discovery
    forest_trees: int = 200
    forest_sample: int = 256
    forest_contamination: float = 0.005
    forest_min_players: int = 100
    forest_seed: int = 7
    # fusion
    review_families: int = 2
    enhanced_families: int = 2
    exceptional_enabled: bool = True
    exceptional_min_z: float = 6.0
    exceptional_min_points: float = 3.0
    exceptional_min_lift: float = 2.0
    exceptional_need_persistence: bool = True
    exceptional_baseline: str = "certified"
    integrity_enabled: bool = True
    integrity_ids: tuple[str, ...] = (
        "L1-MAX_X_BREACH",
        "L1-BALANCE_IDENTITY",
        "L1-DUP_ROUND",
        "LOG-DOUBLE_SETTLE",
        "LOG-ROUND_REPLAY",
    )
    drift_enabled: bool = True
    drift_route_min_points: float = 2.0
    drift_route_min_days: int = 2
    # recency, ingest and logs
    detection_window_days: int = 1
    replay_step_hours: int = 24
    serial_margin: int = 100_000
    modified_lookback_days: int = 3
    log_retention_days: int = 30
    log_lag_guard_s: int = 90
    log_overlap_s: int = 60
    log_window_minutes: int = 1

    def but(self, **changes) -> "Thresholds":
        return replace(self, **changes)
