"""Input tables of the engine, derived from whole test tables.

`oracle.py` holds the same derivations in SQL. No view filters its base table: every row goes
into the view, or into one of its distinct values.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagquality.constants import EMAIL_RULE, EXCLUDE_TAG, NAME_RULE
from tagquality.schemas import COLUMN_TAGS, RULE_MAPPING, TABLE_TAGS
from tagquality.sources.tables import rows_of

SCAN_TAG = "dq"

# Regions as catalogs; two names have the wildcard of LIKE near their end.
CATALOG = """CASE r_name WHEN 'ASIA' THEN 'DEV_U1' WHEN 'EUROPE' THEN 'SALES_EU'
             ELSE replace(r_name, ' ', '_') END"""

# Tags of the scanned columns: table, column, tag value.
SCANNED_COLUMNS = [
    ("customer", "c_name", "personName"),
    ("customer", "c_mktsegment", "segment"),
    ("customer", "c_acctbal", "balance"),
    ("contacts", "email", "email"),
    ("contacts", "segment", "segment"),
    ("part", "p_name", "personName"),
    ("supplier", "s_name", "personName"),
    ("supplier", "s_acctbal", "balance"),
    ("orders", "o_orderpriority", "priority"),
    ("documents", "text", "bodyText"),
    ("conversations", "text", "bodyText"),
    ("pages", "url", "tagWithoutRule"),
]

# Rules of those tags: tag value, rule name, predicate, criticality.
SCAN_RULES = [
    ("personName", "Name Conformance", NAME_RULE, "error"),
    ("email", "Email Conformance", EMAIL_RULE, "error"),
    (
        "segment",
        "Known Segment",
        "{col} IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')",
        "error",
    ),
    ("balance", "Balance In Range", "{col} BETWEEN -900 AND 9000", "error"),
    ("balance", "Balance Not Negative", "{col} >= 0", "warn"),
    ("priority", "Priority Format", "{col} RLIKE '^[1-5]-[A-Z ]+$'", "error"),
    ("priority", "Priority Specified", "{col} <> '4-NOT SPECIFIED'", "warn"),
    ("bodyText", "Text Present", "{col} IS NOT NULL AND LENGTH(TRIM({col})) > 0", "error"),
    ("bodyText", "Text Long Enough", "LENGTH({col}) >= 200", "warn"),
    ("ruleWithoutTag", "Never Bound", "{col} IS NOT NULL", "error"),
]

# Rules that analyse but fail on values of their columns.
FAILING_RULES = [
    ("balance", "Balance Digits", "CAST(CAST({col} AS STRING) AS INT) >= 0", "error"),
    ("priority", "Priority Number", "CAST({col} AS INT) > 0", "warn"),
]

# Tables of the scan with a tag that may exclude them: table, tag value.
SCAN_EXCLUSIONS = [("part", "true"), ("orders", "false"), ("documents", "true")]

# List prices: SKU, start, end, price per unit. One SKU has no price.
PRICES = [
    ("A_F", "1990-01-01", "1998-07-01", 0.55),
    ("A_F", "1998-07-01", None, 0.70),
    ("A_O", "1990-01-01", None, 0.40),
    ("N_F", "1990-01-01", "1997-03-15", 0.22),
    ("N_F", "1997-03-15", None, 0.30),
    ("N_O", "1996-01-01", None, 0.95),
    ("R_F", "1990-01-01", "2000-01-01", 0.15),
]

# End of the period for the reports over each table.
EVENTS_AS_OF = "2024-01-31 00:00:00"
VOLUME_AS_OF = "2024-01-31 12:00:00"
ORDERS_AS_OF = "2001-08-01 00:00:00"
USAGE_AS_OF = "2001-08-01 00:00:00"


class SampleTables:
    """The views over one test directory; built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def schema_count(self) -> Column:
        return self.base("supplier").agg(F.count(F.lit(1))).scalar()

    @cached_property
    def _places(self) -> DataFrame:
        """Suppliers as schemas, regions as catalogs."""
        nations = self.base("nation").join(
            self.base("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.base("supplier")
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "s_suppkey",
                "s_acctbal",
                "n_nationkey",
                f"{CATALOG} AS catalog_name",
                "if(s_acctbal < 0, 'SCHEMAX', 'SCHEMA_') || s_suppkey AS schema_name",
            )
        )

    @cached_property
    def schemata(self) -> DataFrame:
        return self._places.selectExpr(
            "catalog_name", "schema_name", "CAST(s_suppkey AS STRING) AS schema_id"
        )

    @cached_property
    def schema_tags(self) -> DataFrame:
        # Tag name, value, and which schemas carry it.
        tags = [
            ("tenant", "'TENANT_' || (n_nationkey % 7)", "catalog_name <> 'AMERICA'"),
            ("askid", "'ASK-' || n_nationkey", "catalog_name <> 'DEV_U1'"),
            ("askid", "'ASK-SHARED'", "s_acctbal > 9000"),
            ("dqm_monitor", "'enabled'", "s_acctbal >= 5000"),
            ("dqm_monitor", "'paused'", "s_acctbal < 0"),
        ]
        pairs = ", ".join(
            f"if({where}, named_struct('tag_name', '{name}', 'tag_value', {value}), NULL)"
            for name, value, where in tags
        )
        carried = self._places.selectExpr(
            "catalog_name",
            "schema_name",
            f"inline(filter(array({pairs}), t -> t IS NOT NULL)) AS (tag_name, tag_value)",
        )
        retired = (
            self.base("nation")
            .join(self.base("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                f"{CATALOG} AS catalog_name",
                "'RETIRED_' || n_name AS schema_name",
                "'dqm_monitor' AS tag_name",
                "'enabled' AS tag_value",
            )
        )
        return carried.unionByName(retired)

    @cached_property
    def new_tags(self) -> DataFrame:
        """Every schema of two catalogs moves to one tenant; all schemas get a cost tag."""
        move = self._places.where("catalog_name IN ('AFRICA', 'AMERICA')").selectExpr(
            "catalog_name", "schema_name", "'tenant' AS tag_name", "'TENANT_NEW' AS tag_value"
        )
        cost = self._places.selectExpr(
            "catalog_name", "schema_name", "'cost' AS tag_name", "'C' || n_nationkey AS tag_value"
        )
        return move.unionByName(cost)

    @cached_property
    def monitors(self) -> DataFrame:
        return self._places.where("s_acctbal >= 8000").selectExpr(
            "catalog_name", "schema_name", "TIMESTAMP '2024-01-01 00:00:00' AS enabled_at"
        )

    @cached_property
    def tables(self) -> DataFrame:
        place = self._places.select("s_suppkey", "catalog_name", "schema_name")
        return (
            self.base("part")
            .withColumn("_schema", F.col("p_partkey") % self.schema_count)
            .join(place, F.col("_schema") == F.col("s_suppkey"))
            .selectExpr(
                "CAST(p_partkey AS STRING) AS table_id",
                "catalog_name",
                "schema_name",
                "'tbl_' || p_partkey AS table_name",
                "p_type",
                "p_brand",
                "p_size",
            )
        )

    @cached_property
    def column_tags(self) -> DataFrame:
        def tagged(column: str, name: str, value: str) -> DataFrame:
            return self.tables.selectExpr(
                "catalog_name",
                "schema_name",
                "table_name",
                f"'{column}' AS column_name",
                f"'{name}' AS tag_name",
                f"{value} AS tag_value",
            )

        return tagged("name", "dq_type", "p_type").unionByName(
            tagged("brand", "dq_brand", "p_brand")
        )

    @cached_property
    def rule_mapping(self) -> DataFrame:
        types = self.base("part").selectExpr("p_type AS tag_value").distinct()
        brands = self.base("part").selectExpr("p_brand AS tag_value").distinct()

        def rules(of: DataFrame, tag: str, label: str, text: str, level: str) -> DataFrame:
            return of.selectExpr(
                f"'{tag}' AS tag_name",
                "tag_value",
                f"'{label} ' || tag_value AS rule_name",
                f"'{text}' AS sql_expression",
                f"'{level}' AS criticality",
                "CAST(NULL AS TIMESTAMP) AS created_at",
            )

        return (
            rules(types, "dq_type", "Present", "{col} IS NOT NULL", "error")
            .unionByName(rules(types, "dq_type", "Short", "LENGTH({col}) <= 40", "warn"))
            .unionByName(
                rules(
                    brands,
                    "dq_brand",
                    "Brand",
                    "{col} IS NOT NULL",
                    "error",
                )
            )
        )

    @cached_property
    def table_tags(self) -> DataFrame:
        return self.tables.selectExpr(
            "catalog_name",
            "schema_name",
            "table_name",
            "'dqm_exclude' AS tag_name",
            "if(p_size > 40, 'true', 'false') AS tag_value",
        )

    @cached_property
    def scan_tags(self) -> DataFrame:
        rows = [("main", "sales", t, c, SCAN_TAG, v) for t, c, v in SCANNED_COLUMNS]
        return self.spark.createDataFrame(rows, COLUMN_TAGS)

    @cached_property
    def scan_rules(self) -> DataFrame:
        columns = ["tag_name", "tag_value", "rule_name", "sql_expression", "criticality"]
        rows = [(SCAN_TAG, *r) for r in SCAN_RULES]
        return rows_of(self.spark, RULE_MAPPING, columns, rows)

    @cached_property
    def failing_rules(self) -> DataFrame:
        columns = ["tag_name", "tag_value", "rule_name", "sql_expression", "criticality"]
        return rows_of(self.spark, RULE_MAPPING, columns, [(SCAN_TAG, *r) for r in FAILING_RULES])

    @cached_property
    def scan_table_tags(self) -> DataFrame:
        rows = [("main", "sales", t, EXCLUDE_TAG, v) for t, v in SCAN_EXCLUSIONS]
        return self.spark.createDataFrame(rows, TABLE_TAGS)

    @cached_property
    def contacts(self) -> DataFrame:
        """Customers with an e-mail address, good or bad depending on balance and segment."""
        return self.base("customer").selectExpr(
            "c_custkey",
            "nullif(c_mktsegment, 'BUILDING') AS segment",
            """CASE WHEN c_acctbal < 0 THEN 'no-at-sign'
                    WHEN c_acctbal > 9500 THEN '@example.com'
                    WHEN c_acctbal > 9000 THEN 'x' || c_custkey || '@domain'
                    WHEN c_mktsegment = 'MACHINERY' THEN NULL
                    WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 8000 THEN ''
                    ELSE 'user.' || c_custkey || '@example.com' END AS email""",
        )

    def scanned_table(self, full_name: str) -> DataFrame:
        short = full_name.rsplit(".", 1)[-1]
        return self.contacts if short == "contacts" else self.base(short)

    @cached_property
    def usage_flat(self) -> DataFrame:
        return self.base("lineitem").selectExpr(
            "CAST(l_shipdate AS DATE) AS usage_date",
            "l_shipdate AS usage_start_time",
            "'ws-' || l_linenumber AS workspace_id",
            "l_returnflag || '_' || l_linestatus AS sku_name",
            "l_quantity AS usage_quantity",
            """if(l_linenumber IN (1, 3, 5, 7), 'DATA_QUALITY_MONITORING', 'JOBS')
               AS billing_origin_product""",
            "if(l_discount >= 0.095, NULL, CAST(l_suppkey AS STRING)) AS schema_id",
            "if(l_tax > 0.065, 'ext-' || l_partkey, CAST(l_partkey AS STRING)) AS table_id",
            "CAST(l_suppkey AS STRING) AS job_id",
            "CAST(l_orderkey AS STRING) AS job_run_id",
            """CASE l_suppkey % 4 WHEN 0 THEN 'ORCHID-11' WHEN 1 THEN 'BASALT-22'
               WHEN 2 THEN 'HARBOR-33' END AS billing_code""",
            """CASE l_suppkey % 4 WHEN 0 THEN 'Orchid Mills' WHEN 1 THEN 'Basalt Works'
               WHEN 2 THEN 'Harbor Lane' END AS requesting_team""",
            "if(l_partkey % 3 = 0, 'DQ-Scanning', 'Other') AS cost_center",
            "if(l_linenumber < 4, 'ad-hoc', 'scheduled') AS scan_type",
            "l_linenumber > 4 AS is_serverless",
            "'pol-' || (l_partkey % 6) AS policy_id",
        )

    @cached_property
    def usage(self) -> DataFrame:
        tags = ("billing_code", "requesting_team", "cost_center", "scan_type")
        named = F.create_map(*[part for tag in tags for part in (F.lit(tag), F.col(tag))])
        meta = F.struct(
            "schema_id",
            "table_id",
            "job_id",
            "job_run_id",
            F.lit(None).cast("string").alias("notebook_id"),
        )
        return self.usage_flat.withColumns({"usage_metadata": meta, "custom_tags": named}).drop(
            *tags, "schema_id", "table_id", "job_id", "job_run_id"
        )

    @cached_property
    def list_prices(self) -> DataFrame:
        flat = self.spark.createDataFrame(
            PRICES, "sku_name STRING, start STRING, end STRING, price DOUBLE"
        )
        return flat.selectExpr(
            "sku_name",
            "CAST(start AS TIMESTAMP_NTZ) AS price_start_time",
            "CAST(end AS TIMESTAMP_NTZ) AS price_end_time",
            """named_struct('effective_list', named_struct('default', price)) AS pricing""",
        )

    @cached_property
    def daily_prices(self) -> DataFrame:
        """A price for every SKU and day on which it was used."""
        days = self.base("lineitem").selectExpr(
            "l_returnflag || '_' || l_linestatus AS sku_name", "CAST(l_shipdate AS DATE) AS day"
        ).distinct()
        return days.selectExpr(
            "sku_name",
            "CAST(day AS TIMESTAMP_NTZ) AS price_start_time",
            "CAST(date_add(day, 1) AS TIMESTAMP_NTZ) AS price_end_time",
            """named_struct('effective_list', named_struct('default',
                 CAST((dayofyear(day) % 50 + 1) / 100 AS DOUBLE))) AS pricing""",
        )

    @cached_property
    def policies(self) -> DataFrame:
        """A budget policy per type of part; one policy of the usage is not among them."""
        of_type = self.base("part").groupBy(F.expr("p_partkey % 5 AS k")).agg(
            F.min("p_brand").alias("brand")
        )
        return of_type.selectExpr(
            "'pol-' || k AS policy_id",
            "'Policy ' || k AS policy_name",
            """array(named_struct('key', 'billing_code', 'value', 'POL-' || k),
                     named_struct('key', 'cost_center', 'value', brand)) AS custom_tags""",
        )

    @cached_property
    def jobs(self) -> DataFrame:
        return self.base("supplier").selectExpr(
            "CAST(s_suppkey AS STRING) AS job_id",
            "s_name AS name",
            """map('billing_code', 'JOB-' || s_nationkey, 'cost_center', 'DQ-Scanning') AS tags""",
        )

    @cached_property
    def query_history(self) -> DataFrame:
        place = self._places.select("s_suppkey", "catalog_name", "schema_name")
        return (
            self.base("orders")
            .withColumn("_schema", F.col("o_custkey") % self.schema_count)
            .join(place, F.col("_schema") == F.col("s_suppkey"))
            .selectExpr(
                "CAST(o_orderkey AS STRING) AS statement_id",
                "o_orderdate AS start_time",
                """'select * from ' || lower(catalog_name) || '.' || lower(schema_name)
                   || '.tbl_' || o_custkey || ' where k=' || o_orderkey AS statement_text""",
                """CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'FAILED'
                   ELSE 'RUNNING' END AS execution_status""",
                "CAST(floor(o_totalprice) AS BIGINT) AS total_duration_ms",
                "o_custkey AS read_rows",
                "o_custkey * 1048576 AS read_bytes",
            )
        )

    @cached_property
    def table_results(self) -> DataFrame:
        """Events as health results; about a third of the schemas are never scanned."""
        place = self._places.select("s_suppkey", "catalog_name", "schema_name")
        scanned = F.ceil(self.schema_count * 7 / 10).cast("long")
        return (
            self.base("events")
            .withColumn("_schema", F.col("user_id") % scanned)
            .join(place, F.col("_schema") == F.col("s_suppkey"))
            .selectExpr(
                "event_id",
                "ts AS event_time",
                "catalog_name",
                "schema_name",
                "'tbl_' || (user_id % 30) AS table_name",
                "CAST(s_suppkey AS STRING) AS schema_id",
                "CAST(user_id AS STRING) AS table_id",
                """CASE event_type WHEN 'error' THEN 'Unhealthy' WHEN 'signup' THEN NULL
                   WHEN 'view' THEN 'HEALTHY' ELSE 'Healthy' END AS status""",
                """named_struct(
                     'status', if(value < 50, 'Unhealthy', 'Healthy'),
                     'commit_freshness', named_struct(
                       'status', if(value < 50, 'Unhealthy', 'Healthy'),
                       'error_code', CAST(NULL AS STRING),
                       'last_value', ts - INTERVAL '1' HOUR,
                       'predicted_value', ts + INTERVAL '1' HOUR)) AS freshness""",
                """named_struct(
                     'status', if(value > 400, 'Unhealthy', 'Healthy'),
                     'total_row_count', named_struct(
                       'status', if(value > 400, 'Unhealthy', 'Healthy'),
                       'error_code', CAST(NULL AS STRING),
                       'last_value', CAST(floor(value) AS BIGINT),
                       'min_predicted_value', 100L)) AS completeness""",
                """named_struct(
                     'impact_level', if(value > 300, 'HIGH', 'LOW'),
                     'num_downstream_tables', user_id % 9,
                     'num_queries_on_affected_tables', event_id % 50) AS downstream_impact""",
            )
        )

    @cached_property
    def job_run_timeline(self) -> DataFrame:
        return self.base("orders").selectExpr(
            "o_orderkey AS run_id",
            "'run-' || o_orderkey AS run_name",
            """CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED'
               ELSE 'RUNNING' END AS result_state""",
            "o_orderdate AS start_time",
            "o_orderdate + make_dt_interval(0, 0, 0, o_custkey % 600) AS end_time",
        )

    @cached_property
    def dq_results(self) -> DataFrame:
        return self.base("orders").selectExpr(
            "'cat.sch.' || lower(substr(o_orderpriority, 3)) AS table_name",
            "o_orderstatus AS column_name",
            "'rule_' || o_orderstatus AS rule_name",
            "if(o_custkey % 50 = 49, 0, 100 + o_custkey) AS total_rows",
            "if(o_custkey % 50 = 49, 0, o_custkey % 100) AS rows_error",
            "o_custkey % 7 AS rows_warn",
            "o_orderdate AS scan_date",
            "md5('run' || year(o_orderdate)) AS run_id",
        )

    @cached_property
    def commits(self) -> DataFrame:
        return self.base("events").selectExpr(
            "CAST(user_id AS STRING) AS table_id",
            "ts AS commit_time",
            "CAST(floor(value) AS BIGINT) AS rows_added",
        )

    @cached_property
    def writes(self) -> DataFrame:
        """Which run wrote which table: the orders of a part."""
        return self.base("lineitem").selectExpr("CAST(l_partkey AS STRING) AS table_id", "l_orderkey AS run_id")

    @cached_property
    def lineage(self) -> DataFrame:
        """Each table feeds one of two summary tables per line, many lines to an edge."""
        return self.base("lineitem").selectExpr(
            "CAST(l_partkey AS STRING) AS upstream_table_id",
            """CAST(if(l_linenumber < 4, (l_partkey + 2) div 3, (l_partkey + 4) div 5) AS STRING)
               AS downstream_table_id""",
        )

    @cached_property
    def registry(self) -> DataFrame:
        """Customers as clients; each may scan the schemas of two suppliers."""
        count = self.schema_count
        first = self._places.selectExpr(
            "s_suppkey AS _k1", "catalog_name || '.' || schema_name AS _s1"
        )
        second = self._places.selectExpr(
            "s_suppkey AS _k2", "catalog_name || '.' || schema_name AS _s2"
        )
        return (
            self.base("customer")
            .withColumn("_k1", F.col("c_custkey") % count)
            .withColumn("_k2", (F.col("c_custkey") + 1) % count)
            .join(first, "_k1")
            .join(second, "_k2")
            .selectExpr(
                "'BC-' || c_custkey AS billing_code",
                "c_name AS client_name",
                "'dq@' || c_custkey || '.example.com' AS contact_email",
                "_s1 || ', ' || _s2 AS schemas_allowed",
                "c_acctbal >= 0 AS is_active",
                "TIMESTAMP '2024-01-01 00:00:00' AS created_at",
            )
        )

    @cached_property
    def requests(self) -> DataFrame:
        """Orders as scan requests: own schemas, any schema, no schema, unknown code."""
        place = self._places.selectExpr(
            "s_suppkey", "catalog_name || '.' || schema_name AS _schema_name"
        )
        return (
            self.base("orders")
            .withColumn(
                "_k",
                F.expr("if(o_orderpriority = '2-HIGH', o_custkey + 2, o_custkey)")
                % self.schema_count,
            )
            .join(place, F.col("_k") == F.col("s_suppkey"))
            .selectExpr(
                "CAST(o_orderkey AS STRING) AS request_id",
                """if(o_orderpriority = '5-LOW' AND o_orderstatus = 'P', 'NOBODY',
                      'BC-' || o_custkey) AS billing_code""",
                """CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '3-MEDIUM' THEN ''
                   ELSE _schema_name || ' , ' || _schema_name END AS schemas""",
                "'clerk-' || o_orderstatus AS requested_by",
            )
        )
