"""Rules bound to columns through tags, and row-level annotation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tagquality.constants import EMAIL_RULE, NAME_RULE
from tagquality.plans.joins import lookup_join

CRITICALITIES = ("error", "warn")
CHECK_TYPE = "struct<name:string,message:string,criticality:string>"


@dataclass(frozen=True)
class BoundRule:
    """One rule on one column, ready to be evaluated."""

    column: str
    rule_name: str
    predicate: str
    criticality: str

    @property
    def check_name(self) -> str:
        return "dq_check_" + self.rule_name.replace(" ", "_")

    def failed(self, null_result: str = "pass") -> Column:
        """True where the row breaks the rule; never null."""
        if null_result not in ("pass", "fail"):
            raise ValueError(f"null_result must be 'pass' or 'fail', got {null_result!r}")
        return ~F.coalesce(F.expr(self.predicate), F.lit(null_result == "pass"))


def discover_bindings(column_tags: DataFrame, rule_mapping: DataFrame) -> DataFrame:
    """One row per (tagged column, rule of that tag pair)."""
    rules = rule_mapping.select(
        "tag_name", "tag_value", "rule_name", "sql_expression", "criticality"
    )
    return lookup_join(column_tags, rules, ["tag_name", "tag_value"]).select(
        "catalog_name",
        "schema_name",
        "table_name",
        "column_name",
        "rule_name",
        "sql_expression",
        "criticality",
    )


def bind_rule(sql_expression: str, column: str) -> str:
    """Rule text for one column. The name is quoted, so any column name is safe to use."""
    quoted = "`" + column.replace("`", "``") + "`"
    return sql_expression.replace("`{col}`", "{col}").replace("{col}", quoted)


def bound_texts(bindings: DataFrame) -> DataFrame:
    """Bindings with their check name and bound predicate, for review before a scan."""
    quoted = F.concat(
        F.lit("`"), F.replace("column_name", F.lit("`"), F.lit("``")), F.lit("`")
    )
    plain = F.replace("sql_expression", F.lit("`{col}`"), F.lit("{col}"))
    return bindings.withColumns(
        {
            "check_name": F.concat(
                F.lit("dq_check_"), F.replace("rule_name", F.lit(" "), F.lit("_"))
            ),
            "predicate": F.replace(plain, F.lit("{col}"), quoted),
        }
    )


def bound_rules(bindings: Iterable[Row]) -> list[BoundRule]:
    rules = []
    for b in bindings:
        if b["criticality"] not in CRITICALITIES:
            raise ValueError(
                f"rule {b['rule_name']!r}: criticality must be one of {CRITICALITIES}, "
                f"got {b['criticality']!r}"
            )
        text = bind_rule(b["sql_expression"], b["column_name"])
        rules.append(BoundRule(b["column_name"], b["rule_name"], text, b["criticality"]))
    return rules


def why_rejected(df: DataFrame, rule: BoundRule) -> str | None:
    """Why the rule cannot run on this table, or None. Analyses only; starts no job."""
    if rule.criticality not in CRITICALITIES:
        return f"criticality {rule.criticality!r} is not one of {CRITICALITIES}"
    try:
        df.where(rule.predicate).schema  # noqa: B018 - analysis finds the error
    except PySparkException as error:
        return str(error).split("\n")[0]
    return None


def annotate_rows(
    df: DataFrame, rules: Sequence[BoundRule], null_result: str = "pass"
) -> DataFrame:
    """Add `_errors` and `_warnings`: arrays with an entry per broken rule, null where none is."""

    def broken(criticality: str) -> Column:
        entries = [
            F.when(
                r.failed(null_result),
                F.struct(
                    F.lit(r.check_name).alias("name"),
                    F.lit(f"Value is not matching expression: {r.predicate}").alias("message"),
                    F.lit(r.criticality).alias("criticality"),
                ),
            )
            for r in rules
            if r.criticality == criticality
        ]
        if not entries:
            return F.lit(None).cast(f"array<{CHECK_TYPE}>")
        found = F.filter(F.array(*entries), lambda e: e.isNotNull())
        return F.when(F.size(found) > 0, found)

    return df.withColumns({"_errors": broken("error"), "_warnings": broken("warn")})


def name_rules(tag_name: str, first: str = "firstName", last: str = "lastName") -> list[tuple]:
    """Seed rows for the rule table: first and last name must look like names."""
    return [
        (tag_name, first, "First Name Conformance", NAME_RULE, "error", None),
        (tag_name, last, "Last Name Conformance", NAME_RULE, "error", None),
    ]


def email_rule(tag_name: str, tag_value: str = "email") -> tuple:
    """Seed row for the rule table: an e-mail address must look like one."""
    return (tag_name, tag_value, "Email Conformance", EMAIL_RULE, "error", None)
