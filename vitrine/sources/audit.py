"""Audit log and role configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("event string, user string, role string, tool string, params map<string,string>, status string, "
                "elapsed_s double, error string, reason string, action string, _timestamp string")
ROLE_SCHEMA = ("roles map<string, struct<description: string, tools: array<string>>>, "
               "tools map<string, struct<description: string, input_schema: map<string,string>, "
               "requires_logging: boolean>>")

# Tools of each role; every role has those of the one before it.
ROLE_TOOLS = {
    "viewer": ("search_products", "get_top_k", "get_cluster_analysis", "get_product_stats"),
    "analyst": ("search_products", "get_top_k", "get_cluster_analysis", "get_product_stats",
                "get_association_rules", "export_data"),
    "admin": ("search_products", "get_top_k", "get_cluster_analysis", "get_product_stats",
              "get_association_rules", "export_data", "run_pipeline", "manage_permissions"),
}


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit entries; malformed lines are skipped."""
    return spark.read.schema(AUDIT_SCHEMA).option("mode", "DROPMALFORMED").json(path)


def parse_audit(lines: DataFrame, column: str = "value") -> DataFrame:
    """Audit entries from text lines; lines that are not JSON objects are skipped."""
    schema = AUDIT_SCHEMA + ", _corrupt string"
    entry = F.from_json(column, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(entry.alias("e")).filter(
        F.col("e").isNotNull() & F.col("e._corrupt").isNull()).select("e.*").drop("_corrupt")


def append_audit(df: DataFrame, path: str) -> None:
    """Append entries as JSON lines, stamped now where they carry no time."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamped = df.withColumn("_timestamp", F.coalesce("_timestamp", stamp) if "_timestamp" in df.columns else stamp)
    stamped.write.mode("append").json(path)


def read_roles(spark: SparkSession, path: str) -> DataFrame:
    """(role, description, tool) rows of a role configuration file."""
    conf = spark.read.schema(ROLE_SCHEMA).option("multiLine", True).json(path)
    roles = conf.select(F.explode("roles").alias("role", "r"))
    return roles.select("role", "r.description", F.explode("r.tools").alias("tool"))


def read_tools(spark: SparkSession, path: str) -> DataFrame:
    """(tool, description, parameters, requires_logging) rows of the same file."""
    conf = spark.read.schema(ROLE_SCHEMA).option("multiLine", True).json(path)
    tools = conf.select(F.explode("tools").alias("tool", "t"))
    return tools.select("tool", "t.description", F.map_keys("t.input_schema").alias("parameters"),
                        "t.requires_logging")


def role_table(spark: SparkSession) -> DataFrame:
    """The default (role, tool) rows."""
    rows = [(role, tool) for role, tools in ROLE_TOOLS.items() for tool in tools]
    return spark.createDataFrame(rows, "role string, tool string")


def entry_class(event: Column) -> Column:
    """How an entry is shown: denied, error or other."""
    return F.when(event.isin("denied", "error"), event).otherwise("other")
