"""The warehouse's declared data tests (52 checks) as one spec.

The same spec builds the Spark checks (``quality`` operators) and, for the
oracle, the SQL counting each check's failing rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from ..operators import quality as Q

# The twelve service lines a DRG may map to.
SERVICE_LINES = [
    "Cardiology", "Orthopedics", "Neurology", "Oncology", "Pulmonology/Respiratory",
    "Gastroenterology", "Renal/Urology", "Obstetrics", "General Surgery", "General Medicine",
    "Psychiatry", "Other",
]


@dataclass
class Spec:
    model: str
    test: str            # not_null | unique | unique_combination | accepted_values |
                         # relationships | expression
    columns: list[str]
    severity: str = "error"
    where: str | None = None
    to: str | None = None          # relationships parent model
    parent_field: str | None = None  # relationships parent column
    values: list = field(default_factory=list)
    condition: str | None = None   # expression test
    label: str | None = None

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        return f"{self.test}_{self.model}_{'__'.join(self.columns)}"


def specs(service_lines: list[str] | None = None) -> list[Spec]:
    lines = service_lines or SERVICE_LINES
    nn = lambda m, c, **kw: Spec(m, "not_null", [c], **kw)
    un = lambda m, c: Spec(m, "unique", [c])
    return [
        nn("stg_hospital_general_info", "facility_id"), un("stg_hospital_general_info", "facility_id"),
        nn("stg_cost_report", "ccn"), un("stg_cost_report", "ccn"),
        nn("stg_census_acs", "cbsa_code"), un("stg_census_acs", "cbsa_code"),
        nn("stg_zip_cbsa_crosswalk", "zip_code"), nn("stg_zip_cbsa_crosswalk", "cbsa_code"),
        nn("stg_medicare_inpatient", "ccn"), nn("stg_medicare_inpatient", "drg_code"),
        Spec("stg_medicare_inpatient", "unique_combination", ["ccn", "drg_code"]),
        nn("dim_hospital", "hospital_key"), un("dim_hospital", "hospital_key"),
        nn("dim_hospital", "ccn"), un("dim_hospital", "ccn"),
        nn("dim_drg", "drg_key"), un("dim_drg", "drg_key"),
        nn("dim_drg", "drg_code"), un("dim_drg", "drg_code"),
        nn("dim_drg", "service_line"),
        Spec("dim_drg", "accepted_values", ["service_line"], values=lines),
        nn("dim_geography", "geography_key"), un("dim_geography", "geography_key"),
        nn("dim_geography", "cbsa_code"), un("dim_geography", "cbsa_code"),
        nn("fct_medicare_drg", "hospital_key"),
        Spec("fct_medicare_drg", "relationships", ["hospital_key"], to="dim_hospital",
             parent_field="hospital_key"),
        nn("fct_medicare_drg", "drg_key"),
        Spec("fct_medicare_drg", "relationships", ["drg_key"], to="dim_drg", parent_field="drg_key"),
        Spec("fct_medicare_drg", "unique_combination", ["hospital_key", "drg_key"]),
        nn("fct_hospital_finance", "hospital_key"), un("fct_hospital_finance", "hospital_key"),
        Spec("fct_hospital_finance", "relationships", ["hospital_key"], to="dim_hospital",
             parent_field="hospital_key"),
        nn("fct_hospital_finance", "cost_to_charge_ratio", severity="warn"),
        nn("mart_reimbursement_gap", "hospital_key"), nn("mart_reimbursement_gap", "drg_key"),
        nn("mart_reimbursement_gap", "service_line"), nn("mart_reimbursement_gap", "derived_cost"),
        nn("mart_reimbursement_gap", "margin"),
        Spec("mart_reimbursement_gap", "unique_combination", ["hospital_key", "drg_key"]),
        nn("mart_service_line_margin", "service_line_margin_key"),
        un("mart_service_line_margin", "service_line_margin_key"),
        nn("mart_service_line_margin", "service_line"), nn("mart_service_line_margin", "avg_margin"),
        nn("mart_service_line_margin", "global_rank", where="meets_volume_threshold"),
        nn("mart_service_line_margin", "metro_rank", where="meets_volume_threshold"),
        nn("mart_finance_scorecard", "hospital_key"), un("mart_finance_scorecard", "hospital_key"),
        nn("mart_burden_vs_community", "hospital_key"), un("mart_burden_vs_community", "hospital_key"),
        nn("mart_burden_vs_community", "uninsured_rate", where="metro_name is not null"),
        Spec("fct_hospital_finance", "expression", ["cost_to_charge_ratio"], severity="warn",
             condition="cost_to_charge_ratio is not null and "
                       "(cost_to_charge_ratio < 0 or cost_to_charge_ratio > 1)",
             label="assert_ccr_between_0_and_1"),
    ]


def spark_checks(models, service_lines: list[str] | None = None, only=None, bucketed=None) -> list[Q.Check]:
    """``models`` maps a model name to its DataFrame (e.g. a Warehouse).
    ``only`` restricts the tests to those that read no other models.
    ``bucketed`` maps models to the column whose buckets their files are in:
    its values are searched for duplicates within the buckets."""
    out = []
    for s in specs(service_lines):
        if only is not None and not {s.model, s.to or s.model} <= set(only):
            continue
        df = models(s.model)
        c = s.columns
        extra = {}
        if s.test == "not_null":
            failing = Q.not_null(df, c[0], s.where)
            pred = F.col(c[0]).isNull()
            extra = {"source": df, "predicate": pred if not s.where else pred & F.expr(s.where)}
        elif s.test == "unique":
            failing = Q.unique(df, c[0], s.where)
            if not s.where and (bucketed or {}).get(s.model) != c[0]:
                extra = {"source": df, "unique_col": c[0]}
        elif s.test == "unique_combination":
            failing = Q.unique_combination(df, c, s.where)
        elif s.test == "accepted_values":
            failing = Q.accepted_values(df, c[0], s.values, s.where)
        elif s.test == "relationships":
            failing = Q.relationships(df, c[0], models(s.to), s.parent_field, s.where)
        else:
            failing = Q.expression_fails(df, s.condition, s.where)
            pred = F.expr(s.condition)
            extra = {"source": df, "predicate": pred if not s.where else pred & F.expr(s.where)}
        out.append(Q.Check(s.name, s.model, s.test, failing, s.severity, **extra))
    return out


def _sql_count(s: Spec) -> str:
    w = f" AND ({s.where})" if s.where else ""
    wh = f" WHERE {s.where}" if s.where else ""
    c = s.columns
    if s.test == "not_null":
        return f"SELECT count(*) AS n FROM {s.model} WHERE {c[0]} IS NULL{w}"
    if s.test == "unique":
        return (f"SELECT count(*) AS n FROM (SELECT {c[0]} FROM {s.model} WHERE {c[0]} IS NOT NULL{w}"
                f" GROUP BY {c[0]} HAVING count(*) > 1) x")
    if s.test == "unique_combination":
        cols = ", ".join(c)
        return (f"SELECT count(*) AS n FROM (SELECT {cols} FROM {s.model}{wh} GROUP BY {cols}"
                f" HAVING count(*) > 1) x")
    if s.test == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in s.values)
        return (f"SELECT count(*) AS n FROM (SELECT {c[0]} FROM {s.model} WHERE {c[0]} NOT IN ({vals})"
                f"{w} GROUP BY {c[0]}) x")
    if s.test == "relationships":
        return (f"SELECT count(*) AS n FROM {s.model} ch LEFT JOIN (SELECT DISTINCT {s.parent_field} AS pk "
                f"FROM {s.to}) p ON ch.{c[0]} = p.pk WHERE ch.{c[0]} IS NOT NULL AND p.pk IS NULL{w}")
    return f"SELECT count(*) AS n FROM {s.model} WHERE ({s.condition}){w}"


def report_sql(service_lines: list[str] | None = None) -> str:
    parts = []
    for s in specs(service_lines):
        status = (f"CASE WHEN n = 0 THEN 'pass' WHEN '{s.severity}' = 'warn' THEN 'warn' "
                  f"ELSE 'fail' END")
        parts.append(f"SELECT '{s.name}' AS check_name, '{s.model}' AS model, '{s.test}' AS test, "
                     f"'{s.severity}' AS severity, CAST(n AS BIGINT) AS failing_rows, "
                     f"{status} AS status FROM ({_sql_count(s)}) c")
    return "\nUNION ALL\n".join(parts)
