"""Data-quality and leakage reports: one row per check with `passed`, `violations`, `detail`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.aggregates import mean_where
from tidemark.operators.joins import orphans, with_customer
from tidemark.operators.panel import stack_measures
from tidemark.operators.sets import union_tables
from tidemark.operators.windows import trailing_count
from tidemark.plans.features import PLANTED_LEAK, source_months
from tidemark.session import inline_table, scratch_path, write_parquet
from tidemark.sources.schemas import COMPOSITE_KEYS, FOREIGN_KEYS, SCHEMAS, SINGLE_KEYS

# Where a monthly table gets its customer from when it has no customer_id of its own.
OWNER = {
    "account_monthly_snapshot": ("account_master", "account_id"),
    "card_monthly_snapshot": ("card_portfolio", "card_id"),
    "loan_monthly_snapshot": ("loan_master", "loan_id"),
}
ACTIVITY_MONTH = {
    "account_monthly_snapshot": "snapshot_month",
    "card_monthly_snapshot": "snapshot_month",
    "loan_monthly_snapshot": "snapshot_month",
    "product_holdings_monthly": "snapshot_month",
    "customer_monthly_activity": "snapshot_month",
    "digital_engagement_monthly": "snapshot_month",
    "customer_complaints": "complaint_month",
    "customer_feedback": "feedback_month",
    "customer_churn_label": "as_of_month",
    "churn_feature_snapshot": "as_of_month",
    "transaction_fact": "txn_month",
}
# Tables whose rows must lie strictly before the churn month, not merely up to it.
BEFORE_CHURN = ("customer_churn_label", "churn_feature_snapshot")


def _report(
    df: DataFrame, check: str | Column, violations: Column, detail: Column
) -> DataFrame:
    count = F.coalesce(violations, F.lit(0)).cast("bigint")
    name = F.lit(check) if isinstance(check, str) else check
    return df.select(
        name.alias("check_name"), (count == 0).alias("passed"),
        count.alias("violations"), detail.alias("detail"),
    )


def key_check(df: DataFrame, table: str, keys: tuple[str, ...]) -> DataFrame:
    """Rows with a null in the key, and key values that occur more than once.

    Rows are counted per key first, so one grouping serves both answers.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counts = groups.agg(
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("duplicates"),
    )
    detail = F.concat(F.lit("nulls="), "nulls", F.lit(", duplicates="), "duplicates")
    return _report(
        counts, f"key {table}({', '.join(keys)})", F.col("nulls") + F.col("duplicates"), detail
    )


def dq_single_pk(bank) -> DataFrame:
    return union_tables([key_check(bank.table(t), t, (k,)) for t, k in SINGLE_KEYS.items()])


def dq_composite_grain(bank) -> DataFrame:
    return union_tables([key_check(bank.table(t), t, k) for t, k in COMPOSITE_KEYS.items()])


def _per_check(found: DataFrame, names: list[str], *sums: str) -> DataFrame:
    """Totals per check name, with a row of zeros for a check that found nothing."""
    spark = found.sparkSession
    nothing = inline_table(spark, ("check_name",), [(name,) for name in names])
    return stack_measures(
        [nothing, found], ["check_name"],
        {column: F.coalesce(F.sum(column), F.lit(0)) for column in sums},
    )


def _foreign_keys_to(bank, parent: str) -> DataFrame:
    """All references to one parent: children are counted per key, stacked and joined once."""
    checks = [(c, column) for c, column, p in FOREIGN_KEYS if p == parent]
    names = [f"foreign key {child}({column}) -> {parent}" for child, column in checks]
    keys = union_tables([
        bank.table(child).select(F.lit(name).alias("check_name"), F.col(column).alias("key_value"))
        for (child, column), name in zip(checks, names)
    ])
    missing = orphans(keys, "key_value", bank.table(parent), SINGLE_KEYS[parent], ["check_name"])
    found = missing.select(
        "check_name", F.col("orphan_rows").alias("rows"), F.lit(1).alias("keys")
    )
    totals = _per_check(found, names, "rows", "keys")
    detail = F.concat(F.lit("orphan rows="), "rows", F.lit(", keys="), "keys")
    return _report(totals, F.col("check_name"), F.col("rows"), detail)


def dq_foreign_keys(bank) -> DataFrame:
    parents = dict.fromkeys(parent for _, _, parent in FOREIGN_KEYS)
    return union_tables([_foreign_keys_to(bank, parent) for parent in parents])


def _order_check(df: DataFrame, check: str, greater: Column, smaller: Column) -> DataFrame:
    """A one-row report that passes when the first mean exceeds the second."""
    means = df.agg(greater.alias("a"), smaller.alias("b"))

    def text(name: str) -> Column:
        return F.coalesce(
            F.round(F.col(name) * 1_000_000).cast("bigint").cast("string"), F.lit("none")
        )

    wrong = F.when(F.coalesce(F.col("a") > F.col("b"), F.lit(False)), 0).otherwise(1)
    return _report(means, check, wrong, F.concat(text("a"), F.lit(" > "), text("b")))


def dq_persona_churn_order(bank) -> DataFrame:
    """Complaint-prone customers churn more often than salary-core customers."""
    churned = F.col("churned_flag").cast("int")
    return _order_check(
        bank.churn_simulation_state, "persona churn order",
        mean_where(F.col("persona") == "complaint_prone_churner", churned),
        mean_where(F.col("persona") == "salary_core", churned),
    )


def dq_dpd_order(bank) -> DataFrame:
    """Credit-stressed customers are further past due than affluent ones."""
    loans = with_customer(bank.loan_monthly_snapshot, bank.loan_master, "loan_id", "inner")
    rows = loans.select("customer_id", "dpd_days").join(
        bank.churn_simulation_state.select("customer_id", "persona"), "customer_id"
    )
    return _order_check(
        rows, "days past due order",
        mean_where(F.col("persona") == "credit_stressed", F.col("dpd_days")),
        mean_where(F.col("persona") == "affluent_multi_product", F.col("dpd_days")),
    )


def dq_campaign_uptake(bank) -> DataFrame:
    """Customers who respond to campaigns take up products faster."""
    rate, velocity = F.col("campaign_response_rate"), F.col("product_acquisition_velocity_6m")
    return _order_check(
        bank.churn_feature_snapshot, "campaign uptake",
        mean_where(rate > 0, velocity), mean_where(rate == 0, velocity),
    )


def dq_low_sensitivity(bank) -> DataFrame:
    """The low-sensitivity segment churns less than the rest."""
    low, churned = F.col("low_sensitivity_segment"), F.col("churned_flag").cast("int")
    return _order_check(
        bank.churn_simulation_state, "low sensitivity",
        mean_where(~low, churned), mean_where(low, churned),
    )


def leak_label_boundary(bank) -> DataFrame:
    """Churned rows whose as-of month does not lie before the churn date."""
    wrong = F.count_if(F.col("churned") & (F.col("as_of_month") >= F.col("churn_date")))
    counts = bank.churn_feature_snapshot.agg(wrong.alias("n"), F.count(F.lit(1)).alias("rows"))
    return _report(
        counts, "label boundary", F.col("n"),
        F.concat(F.lit("rows="), F.col("rows").cast("string")),
    )


def complaint_window_mismatches(bank) -> DataFrame:
    """Feature rows whose complaint count differs from a recount over [as_of - 6, as_of).

    Horizons of one as-of month share the recount, so rows are reduced to the month first.
    """
    wanted = bank.churn_feature_snapshot.groupBy("customer_id", "as_of_month").agg(
        F.max("complaint_count_6m").alias("high"), F.min("complaint_count_6m").alias("low"),
        F.count(F.lit(1)).alias("rows"),
    )
    # Counted and joined: without this the feature table is made twice.
    wanted = write_parquet(wanted, scratch_path(bank.spark, "complaint-windows")).hint("merge")
    recount = trailing_count(wanted, bank.customer_complaints, "complaint_month", 6)
    rows = wanted.join(recount, ["customer_id", "as_of_month"])
    expected = F.col("counted")
    return rows.filter((F.col("high") != expected) | (F.col("low") != expected))


def leak_complaint_window(bank) -> DataFrame:
    counts = complaint_window_mismatches(bank).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n")
    )
    return _report(counts, "complaint window", F.col("n"), F.lit("[M-6, M)"))


def post_churn_activity(bank) -> DataFrame:
    """Rows of monthly tables that lie after their customer's churn month.

    Rows are counted per table, customer and month, then all tables meet the state in one join:
    a customer with very many rows arrives there as one row per table and month.
    """
    gone = bank.churn_simulation_state.filter("churned_flag").select("customer_id", "churn_month")
    parts, names = [], []
    for table, column in ACTIVITY_MONTH.items():
        rows = bank.table(table)
        if table in OWNER:
            master, key = OWNER[table]
            rows = with_customer(rows, bank.table(master), key, "inner")
        names.append(f"post churn {table}")
        parts.append(rows.select(
            F.lit(names[-1]).alias("check_name"), "customer_id", F.col(column).alias("month")
        ))
    months = union_tables(parts).groupBy("check_name", "customer_id", "month").agg(
        F.count(F.lit(1)).alias("n")
    )
    before = F.col("check_name").isin(*[f"post churn {table}" for table in BEFORE_CHURN])
    late = (F.col("month") > F.col("churn_month")) | (
        before & (F.col("month") == F.col("churn_month"))
    )
    found = months.join(gone, "customer_id").filter(late).select("check_name", "n")
    totals = _per_check(found, names, "n")
    rule = F.when(before, ">= churn month").otherwise("> churn month")
    return _report(totals, F.col("check_name"), F.col("n"), rule)


def dq_date_monotonic(bank) -> DataFrame:
    """Accounts open before their snapshots, cards issued before expiry, loans before maturity."""
    opened = bank.account_monthly_snapshot.groupBy("account_id").agg(
        F.min("snapshot_month").alias("first_month")
    ).join(bank.account_master.select("account_id", "open_date"), "account_id")
    checks = [
        ("account open", opened, F.trunc("open_date", "MM") > F.col("first_month")),
        ("card expiry", bank.card_portfolio, F.col("issue_date") >= F.col("expiry_date")),
        ("loan maturity", bank.loan_master,
         F.col("disbursement_date") >= F.col("maturity_date")),
    ]
    return union_tables([
        _report(
            df.agg(F.count_if(wrong).alias("n"), F.count(F.lit(1)).alias("rows")),
            f"dates {name}", F.col("n"),
            F.concat(F.lit("rows="), F.col("rows").cast("string")),
        )
        for name, df, wrong in checks
    ])


KEY_PARTS = {T.LongType(): "key_number", T.StringType(): "key_text", T.DateType(): "key_date",
             T.IntegerType(): "key_int"}


def _key_facts(bank, spaces: list[str]) -> DataFrame:
    """All keys and references of all tables, stacked: each table is read once.

    A fact is a key value in the space of the table whose key it is; slot 0 is that table itself,
    slot k the k-th reference to it.
    """
    facts: dict[str, list[Column]] = {table: [] for table in SCHEMAS}

    def fact(space: str, slot: int, table: str, columns: tuple[str, ...]) -> None:
        parts = {
            name: F.lit(None).cast(kind.simpleString()).alias(name) for kind, name in KEY_PARTS.items()
        }
        is_null = F.lit(False)
        for column in columns:
            name = KEY_PARTS[SCHEMAS[table][column].dataType]
            parts[name] = F.col(column).alias(name)
            is_null = is_null | F.col(column).isNull()
        facts[table].append(F.struct(
            F.lit(spaces.index(space)).alias("space"), F.lit(slot).alias("slot"),
            is_null.alias("is_null"), *parts.values(),
        ))

    for table, key in SINGLE_KEYS.items():
        fact(table, 0, table, (key,))
    for table, keys in COMPOSITE_KEYS.items():
        fact(table, 0, table, keys)
    for parent in SINGLE_KEYS:
        references = [(child, column) for child, column, p in FOREIGN_KEYS if p == parent]
        for slot, (child, column) in enumerate(references, 1):
            fact(parent, slot, child, (column,))
    return union_tables([
        bank.table(table).select(F.inline(F.array(*rows))) for table, rows in facts.items() if rows
    ])


def all_keys(bank) -> DataFrame:
    """The rows of `dq_single_pk`, `dq_composite_grain` and `dq_foreign_keys` from one grouping."""
    keys = {t: (k,) for t, k in SINGLE_KEYS.items()} | dict(COMPOSITE_KEYS)
    spaces = list(keys)
    references = {
        parent: [(child, column) for child, column, p in FOREIGN_KEYS if p == parent] for parent in spaces
    }
    slots = range(1, 1 + max(map(len, references.values())))
    groups = _key_facts(bank, spaces).groupBy("space", "is_null", *KEY_PARTS.values()).agg(*[
        F.count_if(F.col("slot") == k).alias(f"n{k}") for k in (0, *slots)
    ])
    orphan = ~F.col("is_null") & (F.col("n0") == 0)
    totals = groups.groupBy("space").agg(
        F.sum(F.when(F.col("is_null"), F.col("n0"))).alias("nulls"),
        F.count_if(F.col("n0") > 1).alias("duplicates"),
        *[F.sum(F.when(orphan, F.col(f"n{k}"))).alias(f"rows{k}") for k in slots],
        *[F.count_if(orphan & (F.col(f"n{k}") > 0)).alias(f"keys{k}") for k in slots],
    )
    # A row per table, also for those without any.
    numbered = inline_table(bank.spark, ("space",), [(k,) for k in range(len(spaces))])
    counted = numbered.join(totals, "space", "left").fillna(0)

    def check(space: str, name: str, violations: Column, *detail) -> Column:
        return F.struct(
            F.lit(spaces.index(space)).alias("of"), F.lit(name).alias("check_name"),
            violations.alias("violations"), F.concat(*detail).alias("detail"),
        )

    checks = []
    for space, columns in keys.items():
        checks.append(check(
            space, f"key {space}({', '.join(columns)})", F.col("nulls") + F.col("duplicates"),
            F.lit("nulls="), "nulls", F.lit(", duplicates="), "duplicates",
        ))
        checks += [
            check(
                space, f"foreign key {child}({column}) -> {space}", F.col(f"rows{k}"),
                F.lit("orphan rows="), f"rows{k}", F.lit(", keys="), f"keys{k}",
            ) for k, (child, column) in enumerate(references[space], 1)
        ]
    found = counted.select("space", F.inline(F.array(*checks))).filter(F.col("of") == F.col("space"))
    return _report(found, F.col("check_name"), F.col("violations"), F.col("detail"))


REPORTS = (
    dq_single_pk, dq_composite_grain, dq_foreign_keys, dq_persona_churn_order, dq_dpd_order,
    dq_campaign_uptake, dq_low_sensitivity, leak_label_boundary, leak_complaint_window,
    post_churn_activity, dq_date_monotonic,
)


def validation_report(bank) -> DataFrame:
    """Every check, plus one row that passes only if all of them do.

    Keys and references are checked together, so each table is read once for all of them.
    """
    others = REPORTS[3:]
    checks = union_tables([all_keys(bank), *[report(bank) for report in others]])
    failed = F.count_if(~F.col("passed"))
    twice = F.explode(F.array(F.lit(False), F.lit(True))).alias("overall")
    stacked = checks.select("*", twice)
    name = F.when(F.col("overall"), "overall").otherwise(F.col("check_name"))
    detail = F.when(F.col("overall"), F.lit("all checks")).otherwise(F.col("detail"))
    return stacked.groupBy(name.alias("check_name"), detail.alias("detail")).agg(
        (failed == 0).alias("passed"), F.sum("violations").alias("violations")
    ).select("check_name", "passed", "violations", "detail")


def schema_contract(bank, names: tuple[str, ...] = tuple(SCHEMAS)) -> DataFrame:
    """Declared against actual columns: type, nulls where none are allowed, text too long.

    One pass per table computes the null counts and longest texts of all its columns.
    """
    reports = []
    for name in names:
        df, declared = bank.table(name), SCHEMAS[name]
        actual = {f.name: f.dataType.simpleString() for f in df.schema}
        shared = [f for f in declared if f.name in actual]
        measured = df.agg(*[
            F.struct(
                F.count_if(F.col(f.name).isNull()).alias("nulls"),
                (F.max(F.length(f.name)) if isinstance(f.dataType, T.StringType)
                 else F.lit(None).cast("int")).alias("longest"),
            ).alias(f.name)
            for f in shared
        ])
        expected = {f.name: f for f in declared}
        rows = [
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(f.dataType.simpleString() if f else None).cast("string").alias("declared"),
                F.lit(actual.get(column)).cast("string").alias("actual"),
                F.lit(bool(f and not f.nullable)).alias("required"),
                F.lit(f.metadata.get("max_length") if f else None).cast("int").alias("limit"),
                (F.col(f"{column}.nulls") if f and column in actual
                 else F.lit(None).cast("bigint")).alias("nulls"),
                (F.col(f"{column}.longest") if f and column in actual
                 else F.lit(None).cast("int")).alias("longest"),
            )
            for column in [*expected, *[c for c in actual if c not in expected]]
            for f in [expected.get(column)]
        ]
        reports.append(measured.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    problem = (
        F.when(F.col("actual").isNull(), "missing column")
        .when(F.col("declared").isNull(), "extra column")
        .when(F.col("actual") != F.col("declared"), "type mismatch")
        .when(F.col("required") & (F.col("nulls") > 0), "nulls not allowed")
        .when(F.col("longest") > F.col("limit"), "text too long")
        .otherwise("ok")
    )
    return union_tables(reports).withColumn("status", problem)


def leak_future_months(bank, planted: dict = PLANTED_LEAK) -> DataFrame:
    """Per feature and as-of month: rows, rows with a source, rows that look ahead, largest lead.

    Each row's latest source month is compared with its as-of month: a feature may use earlier
    months only, so a lead of 0 or more is a leak. All as-of months are checked in one pass.
    """
    months = source_months(bank, planted)
    names = [c for c in months.columns if c not in ("customer_id", "as_of_month", "month_idx")]
    leads = months.select("as_of_month", F.inline(F.array(*[
        F.struct(F.lit(n).alias("feature"), (F.col(n) - F.col("month_idx")).alias("lead"))
        for n in names
    ])))
    return leads.groupBy("feature", "as_of_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("lead").alias("n_sourced"),
        F.count_if(F.col("lead") >= 0).alias("n_leaking"), F.max("lead").alias("largest_lead"),
    )


def changed_by_later_facts(bank, features, cut) -> DataFrame:
    """Features of as-of months up to `cut` that change when facts from `cut` on are removed.

    The same question asked by experiment, for one cut: a feature that only looks at earlier
    months cannot notice. The labels stay, they are not features. Empty when nothing leaks.
    """
    def before(table: str, column: str) -> DataFrame:
        return bank.table(table).filter(F.col(column) < F.lit(cut))

    altered = bank.replace(**{
        table: before(table, column) for table, column in ACTIVITY_MONTH.items()
        if table not in (*BEFORE_CHURN, "transaction_fact")
    })
    base = features(bank).filter(F.col("as_of_month") <= F.lit(cut))
    other = features(altered).filter(F.col("as_of_month") <= F.lit(cut))
    keys = ["customer_id", "as_of_month"]
    names = [c for c in base.columns if c not in keys]
    joined = base.alias("a").join(other.alias("b"), keys, "full_outer")
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return joined.filter(~same).select(*keys)
