"""Table constraints as checks that return the violating rows.

Row-level rules of a table are evaluated together in one scan. Key rules are aggregates that
combine before the shuffle. A null passes every rule except NOT NULL, as in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_domain(column: str, allowed: list) -> Column:
    return F.col(column).isin(*allowed)


def in_range(column: str, low=None, high=None) -> Column:
    """Bounds are inclusive; None leaves a side open."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (F.col(column) >= F.lit(low))
    if high is not None:
        ok = ok & (F.col(column) <= F.lit(high))
    return ok


def present(column: str) -> Column:
    return F.col(column).isNotNull()


def at_most_chars(column: str, limit: int) -> Column:
    return F.length(column) <= limit


def fits_decimal(column: str, precision: int, scale: int) -> Column:
    return F.col(column).isNull() | F.col(column).try_cast(
        f"decimal({precision},{scale})"
    ).isNotNull()


def violations(df: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """(key…, rule) for every broken rule, in one pass over the rows."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(ok, F.lit(True)), F.lit(name))
                for name, ok in rules.items()
            ]
        )
    )
    return df.select(*key, F.explode(broken).alias("rule"))


def duplicate_keys(df: DataFrame, keys: list[str], nulls_count: bool = False) -> DataFrame:
    """Keys that occur more than once; for UNIQUE a null in any part exempts the row."""
    rows = df.select(*keys)
    if not nulls_count:
        rows = rows.dropna("any")
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key rows with a null part."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.select(*keys).filter(missing)


def more_than_one(df: DataFrame, condition: Column) -> DataFrame:
    """One row with the count when more than one row meets a condition, else no row."""
    return df.filter(condition).agg(F.count("*").alias("active")).filter("active > 1")


def orphans(child: DataFrame, foreign: str, parent: DataFrame, primary: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    keys = parent.select(F.col(primary).alias(foreign))
    return child.filter(F.col(foreign).isNotNull()).join(keys, foreign, "left_anti")


def cascade(child: DataFrame, foreign: str, deleted: DataFrame, primary: str) -> DataFrame:
    """Child rows left after a parent delete that cascades."""
    keys = deleted.select(F.col(primary).alias(foreign))
    return child.join(keys, foreign, "left_anti").select(*child.columns)


def set_null(child: DataFrame, foreign: str, deleted: DataFrame, primary: str) -> DataFrame:
    """Child rows with the foreign key cleared where the parent was deleted."""
    gone = deleted.select(F.col(primary).alias(foreign), F.lit(True).alias("_gone"))
    cleared = F.when(F.col("_gone").isNull(), F.col(foreign))
    return (
        child.join(gone.dropDuplicates([foreign]), foreign, "left")
        .withColumn(foreign, cleared)
        .select(*child.columns)
    )


def restricted(deleted: DataFrame, primary: str, child: DataFrame, foreign: str) -> DataFrame:
    """Parent rows whose delete must be refused because a child refers to them."""
    keys = child.select(F.col(foreign).alias(primary))
    return deleted.join(keys, primary, "left_semi")


@dataclass(frozen=True)
class TableRules:
    """Declared rules of one table."""

    key: list[str]
    domains: dict[str, list] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    lengths: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    unique: list[list[str]] = field(default_factory=list)

    def row_rules(self, columns: list[str]) -> dict[str, Column]:
        """Rules for the columns a frame really has."""
        rules: dict[str, Column] = {}
        for c, allowed in self.domains.items():
            rules[f"domain:{c}"] = in_domain(c, allowed)
        for c, (low, high) in self.ranges.items():
            rules[f"range:{c}"] = in_range(c, low, high)
        for c in self.required:
            rules[f"required:{c}"] = present(c)
        for c, limit in self.lengths.items():
            rules[f"length:{c}"] = at_most_chars(c, limit)
        for c, (precision, scale) in self.decimals.items():
            rules[f"decimal:{c}"] = fits_decimal(c, precision, scale)
        return {name: ok for name, ok in rules.items() if name.split(":")[1] in columns}


# The declared constraints of the review and media tables.
RULES = {
    "audio_files": TableRules(
        key=["id"],
        required=["original_filename", "opus_path"],
        unique=[["id"], ["opus_path"]],
    ),
    "pipeline_transcripts": TableRules(key=["id"], unique=[["id"]]),
    "pipeline_classifications": TableRules(key=["id"], required=["flagged"], unique=[["id"]]),
    "transcripts": TableRules(
        key=["meta_id"],
        domains={"queue_status": ["unqueued", "queued", "in_progress", "completed", "excluded"]},
        ranges={"month": (1, 12), "day": (1, 31)},
        required=["meta_id", "year", "month", "day", "transcript"],
        lengths={
            "meta_id": 255,
            "country": 50,
            "lang": 20,
            "queue_status": 20,
            "review_status": 30,
            "confidence_level": 10,
            "treatment_assignment": 10,
            "report_region": 10,
        },
        decimals={"label_1_pred": (10, 9)},
        unique=[["meta_id"]],
    ),
    "creators": TableRules(
        key=["creator_id"],
        required=["creator_id", "author_uniqueid"],
        lengths={"author_uniqueid": 100},
        unique=[["creator_id"], ["author_uniqueid"]],
    ),
    "backlog": TableRules(
        key=["backlog_id"],
        required=["backlog_id", "first_report_date", "last_report_date"],
        lengths={"meta_id": 255, "removal_reason": 20},
        unique=[["backlog_id"], ["meta_id"]],
    ),
    "daily_randomization": TableRules(
        key=["randomization_date"],
        domains={
            "last_treatment": ["treatment", "control"],
            "report_region": ["US", "EU", "LATAM"],
        },
        required=["randomization_date", "report_region"],
        lengths={"report_region": 10, "last_treatment": 20},
        unique=[["randomization_date"]],
    ),
    "devices": TableRules(
        key=["device_id"],
        required=["device_id", "device_label", "region"],
        lengths={"device_label": 50, "region": 10, "country": 10},
        unique=[["device_id"], ["device_label"]],
    ),
    "experiment_config": TableRules(
        key=["config_id"],
        ranges={
            "label_threshold": (0, 1),
            "treatment_split": (0, 1),
            "min_items_per_stratum": (0, None),
            "queue_size_per_ra": (1, None),
        },
        required=["config_id", "config_name"],
        lengths={"config_name": 100},
        decimals={"label_threshold": (10, 9), "treatment_split": (3, 2)},
        unique=[["config_id"]],
    ),
    "queue_assignments": TableRules(
        key=["assignment_id"],
        domains={
            "status": ["pending", "in_progress", "completed", "skipped"],
            "treatment_round": [1, 2],
        },
        required=["assignment_id", "user_id"],
        lengths={
            "meta_id": 255,
            "treatment_group": 50,
            "status": 20,
            "assignment_type": 20,
            "last_language": 10,
        },
        decimals={"label_1_pred": (10, 9)},
        unique=[["assignment_id"], ["meta_id", "treatment_round"]],
    ),
    "queue_batches": TableRules(
        key=["batch_id"],
        domains={"status": ["generated", "active", "completed", "failed", "cancelled"]},
        required=["batch_id", "generation_date"],
        lengths={"status": 20},
        unique=[["batch_id"]],
    ),
    "ra_availability": TableRules(
        key=["availability_id"],
        required=["availability_id", "work_date"],
        decimals={"expected_hours": (4, 2)},
        unique=[["availability_id"], ["ra_id", "work_date"]],
    ),
    "ra_devices": TableRules(
        key=["ra_id", "device_id"],
        required=["ra_id", "device_id"],
        unique=[["ra_id", "device_id"]],
    ),
    "second_review_queue": TableRules(
        key=["review_id"],
        required=["review_id"],
        lengths={"meta_id": 255, "status": 20},
        unique=[["review_id"], ["meta_id"]],
    ),
    "user_classifications": TableRules(
        key=["classification_id"],
        domains={"treatment_round": [1, 2]},
        required=["classification_id", "user_id", "treatment_round"],
        lengths={"meta_id": 255, "confidence_level": 10},
        unique=[["classification_id"]],
    ),
    "users": TableRules(
        key=["user_id"],
        domains={"role": ["admin", "researcher", "supervisor"]},
        required=["user_id", "username", "password_hash"],
        lengths={
            "username": 50,
            "password_hash": 255,
            "email": 255,
            "full_name": 100,
            "role": 20,
        },
        unique=[["user_id"], ["email"], ["username"]],
    ),
}

# Fixed values: (child, column, parent, parent key, effect of a parent delete).
FOREIGN_KEYS = [
    ("backlog", "first_report_device_id", "devices", "device_id", "none"),
    ("backlog", "meta_id", "transcripts", "meta_id", "cascade"),
    ("experiment_config", "created_by_user_id", "users", "user_id", "none"),
    ("pipeline_classifications", "audio_file_id", "audio_files", "id", "cascade"),
    ("pipeline_transcripts", "audio_file_id", "audio_files", "id", "cascade"),
    ("queue_assignments", "batch_id", "queue_batches", "batch_id", "cascade"),
    ("queue_assignments", "device_id", "devices", "device_id", "none"),
    ("queue_assignments", "meta_id", "transcripts", "meta_id", "cascade"),
    ("queue_assignments", "user_id", "users", "user_id", "restrict"),
    ("queue_batches", "config_id", "experiment_config", "config_id", "none"),
    ("queue_batches", "generated_by_user_id", "users", "user_id", "none"),
    ("ra_availability", "ra_id", "users", "user_id", "cascade"),
    ("ra_availability", "updated_by", "users", "user_id", "none"),
    ("ra_devices", "device_id", "devices", "device_id", "cascade"),
    ("ra_devices", "ra_id", "users", "user_id", "cascade"),
    ("second_review_queue", "first_reviewer_id", "users", "user_id", "none"),
    ("second_review_queue", "meta_id", "transcripts", "meta_id", "cascade"),
    ("second_review_queue", "second_reviewer_id", "users", "user_id", "none"),
    ("transcripts", "creator_id", "creators", "creator_id", "set_null"),
    ("transcripts", "first_report_device_id", "devices", "device_id", "none"),
    ("user_classifications", "meta_id", "transcripts", "meta_id", "cascade"),
    ("user_classifications", "user_id", "users", "user_id", "restrict"),
]


def check_table(df: DataFrame, table: str) -> DataFrame:
    """Broken row-level rules of a table as (key…, rule)."""
    rules = RULES[table]
    return violations(df, rules.key, rules.row_rules(df.columns))


def check_uniques(df: DataFrame, table: str) -> list[DataFrame]:
    """One frame of repeated keys per declared key of the table."""
    rules = RULES[table]
    return [
        duplicate_keys(df, keys) for keys in rules.unique if set(keys) <= set(df.columns)
    ]


def delete_effect(child: DataFrame, child_name: str, column: str, deleted: DataFrame) -> DataFrame:
    """The child table after parents were deleted, by the declared effect of that key.

    For "restrict" and "none" the result is the parent rows whose delete is refused.
    """
    key, effect = next(
        (pk, how) for c, fk, _, pk, how in FOREIGN_KEYS if (c, fk) == (child_name, column)
    )
    if effect == "cascade":
        return cascade(child, column, deleted, key)
    if effect == "set_null":
        return set_null(child, column, deleted, key)
    return restricted(deleted, key, child, column)
