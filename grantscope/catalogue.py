"""Rule catalogue, scoring weights and control metadata.

FIXED VALUES: everything below must equal the access-review control
definition for results to match (rule ids, names, types, severities, SLA
hours, framework references, scoring weights and defaults, SoD role pairs,
the departments whose roles do not need elevated access, notification
routing, retention and control metadata). Kept together, in catalogue order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ── FIXED VALUES ────────────────────────────────────────────────────────────

RULES: list[dict] = [
    {"id": "RULE-001", "name": "Terminated User Active Access", "type": "TERMINATED_ACCESS",
     "severity": "CRITICAL", "sla_hours": 24,
     "frameworks": ["SOC 2 CC6.2", "PCI DSS 8.1.4", "ISO 27001 A.9.2.6"]},
    {"id": "RULE-002", "name": "Dormant Access — 90 Days", "type": "DORMANT_ACCESS",
     "severity": "HIGH", "sla_hours": 168,
     "frameworks": ["SOC 2 CC6.3", "PCI DSS 7.2.4", "ISO 27001 A.9.2.5"]},
    {"id": "RULE-003", "name": "Excessive Privilege — Role Mismatch", "type": "EXCESSIVE_PRIVILEGE",
     "severity": "HIGH", "sla_hours": 72,
     "frameworks": ["SOC 2 CC6.3", "PCI DSS 7.2.1", "ISO 27001 A.9.2.2"]},
    {"id": "RULE-004", "name": "Separation of Duties Conflict", "type": "SOD_CONFLICT",
     "severity": "CRITICAL", "sla_hours": 48,
     "frameworks": ["SOC 2 CC6.3", "PCI DSS 6.4.1", "ISO 27001 A.9.4.2"]},
    {"id": "RULE-005", "name": "MFA Not Enabled on Privileged Account", "type": "MFA_MISSING",
     "severity": "HIGH", "sla_hours": 24,
     "frameworks": ["SOC 2 CC6.1", "PCI DSS 8.4.2", "ISO 27001 A.9.4.2"]},
    {"id": "RULE-006", "name": "Orphaned Account — No Active Owner", "type": "ORPHANED_ACCOUNT",
     "severity": "HIGH", "sla_hours": 72,
     "frameworks": ["SOC 2 CC6.2", "PCI DSS 8.2.1", "ISO 27001 A.9.2.1"]},
    {"id": "RULE-007", "name": "Critical System Access Without Justification", "type": "UNJUSTIFIED_CRITICAL_ACCESS",
     "severity": "MEDIUM", "sla_hours": 120,
     "frameworks": ["SOC 2 CC6.3", "PCI DSS 7.2.2", "ISO 27001 A.9.2.3"]},
]

SEVERITY_BASE = {"CRITICAL": 100, "HIGH": 70, "MEDIUM": 40, "LOW": 15}
CRITICALITY_MULTIPLIER = {"critical": 1.00, "high": 0.80, "medium": 0.55, "low": 0.30}
ACCESS_LEVEL_MULTIPLIER = {"admin": 1.00, "elevated": 0.75, "standard": 0.45}
DEFAULT_SEVERITY_BASE = 40
DEFAULT_CRITICALITY_MULTIPLIER = 0.55
DEFAULT_ACCESS_LEVEL_MULTIPLIER = 0.45

# Band thresholds: score >= 80 CRITICAL, >= 55 HIGH, >= 30 MEDIUM, else LOW.
BAND_THRESHOLDS = [(80, "CRITICAL"), (55, "HIGH"), (30, "MEDIUM")]
BAND_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]

SOD_CONFLICT_PAIRS = [
    ("financial_initiator", "financial_approver"),
    ("code_developer", "code_deployer"),
    ("user_admin", "user_auditor"),
    ("data_entry", "data_approver"),
]

STANDARD_ROLE_DEPARTMENTS = ["Sales", "Marketing", "Legal"]
PRIVILEGED_LEVELS = ["admin", "elevated"]
DORMANCY_DAYS = 90

EMPLOYEE_STATUSES = ["active", "terminated", "on_leave"]
ACCESS_LEVELS = ["admin", "elevated", "standard"]
CRITICALITIES = ["critical", "high", "medium", "low"]

# Words in a job title that make its holder a manager (case-sensitive).
MANAGER_TITLE_WORDS = ["Manager", "Director", "VP", "CISO", "CFO", "CMO", "COO", "CRO", "CEO"]

NOTIFICATIONS = {
    "critical": {"notify_within_hours": 1, "recipients": ["CISO", "Security Team Lead", "System Owner"]},
    "high": {"notify_within_hours": 4, "recipients": ["Security Team", "System Owner"]},
    "medium": {"notify_within_hours": 24, "recipients": ["Security Team"]},
    "low": {"notify_within_hours": 72, "recipients": ["Security Team"]},
}

EVIDENCE_RETENTION_YEARS = 7

CONTROL = {
    "id": "CTRL-IAM-001",
    "name": "Privileged Access Review",
    "owner": "Security Team",
    "frequency": "Continuous (was quarterly)",
    "frameworks": [
        {"ref": "SOC 2 CC6.2", "description": "Logical access is removed on a timely basis"},
        {"ref": "PCI DSS 7.2.1", "description": "Access is based on need to know"},
        {"ref": "ISO 27001 A.9.2.6", "description": "Access rights of employees are removed upon termination"},
    ],
}

COMPLIANCE_FRAMEWORKS = ["SOC 2 Type II", "PCI DSS v4.0", "ISO 27001:2022"]

# Finding detail texts, one per rule ({name} = a field of the hit).
DETAIL_TEMPLATES = {
    "RULE-001": "Employee terminated {term_days} day(s) ago; access to '{system_name}' was never revoked.",
    "RULE-002": "Access to '{system_name}' has not been used in {days_unused} days (last used {last_used_date}).",
    "RULE-003": "'{full_name}' ({department}) holds {level_upper} access on '{system_name}'. "
                "Role does not require elevated privilege.",
    "RULE-004": "SoD violation: '{full_name}' holds both '{role_a}' and '{role_b}' roles on '{system_name}'. "
                "Compensating control or role split required.",
    "RULE-005": "'{full_name}' has {level_upper} privileges but MFA is not enabled on their account. "
                "Mandatory for all privileged access.",
    "RULE-006": "Account ACC:{access_id} on '{system_name}' is active but owner '{full_name}' is terminated "
                "with no recorded business justification.",
    "RULE-007": "'{full_name}' has access to '{system_name}' (CRITICAL tier) with no recorded business "
                "justification. Approval documentation is required.",
}

# Identifiers and texts of the outputs.
FINDING_ID_PREFIX = "FND-"
PACKAGE_ID_PREFIX = "EVD-"
PACKAGE_DIR_PREFIX = "evidence_package_"
REVIEW_PERIOD_PREFIX = "Continuous — Snapshot as of "
PACKAGE_FILES = ["findings.csv", "findings.json", "access_snapshot.csv", "employee_snapshot.csv", "summary.json"]
FINDING_STATUS_OPEN = "OPEN"
EMPLOYEE_SNAPSHOT_COLUMNS = ["employee_id", "full_name", "department", "title", "status", "hire_date",
                             "termination_date"]

# Display settings: page size, top-N sizes, text truncation widths.
FINDINGS_PER_PAGE = 12
TOP_SYSTEMS = 10
TOP_DEPARTMENTS = 8
REPORT_DETAIL_WIDTH = 120
CARD_DETAIL_WIDTH = 150

# Display tiers of a score: console risk style (>= 70, >= 40) and average-risk gauge (>= 70, >= 45, >= 25).
CONSOLE_RISK_STYLES = [(70, "bold red"), (40, "yellow")]
CONSOLE_RISK_STYLE_DEFAULT = "green"
GAUGE_TIERS = [(70, "red"), (45, "orange"), (25, "amber")]
GAUGE_TIER_DEFAULT = "green"

# ── end of fixed values ─────────────────────────────────────────────────────

RULE_BY_ID = {r["id"]: r for r in RULES}

# Name of this tool in the evidence metadata.
GENERATED_BY = "grantscope"
SOD_ROLES = [role for pair in SOD_CONFLICT_PAIRS for role in pair]


@dataclass(frozen=True)
class RuleParams:
    """Tunable detection parameters (the catalogue defaults unless overridden)."""

    dormancy_days: int = DORMANCY_DAYS
    standard_departments: tuple = tuple(STANDARD_ROLE_DEPARTMENTS)
    privileged_levels: tuple = tuple(PRIVILEGED_LEVELS)
    sod_pairs: tuple = tuple(SOD_CONFLICT_PAIRS)
    rules: tuple = field(default_factory=lambda: tuple(RULES))
    # Route the grants of owners holding a large share of all grants through a
    # broadcast join instead of the shuffle join (explicit skew split).
    split_hot_owners: bool = False
