"""Bias-analysis configuration (pretty-printed or single-line JSON)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Values are read as their spelling, numbers and booleans too; the columns' types decide.
BIAS_CONFIG_SCHEMA = StructType([
    StructField("dataset_type", StringType()),
    StructField("headers", ArrayType(StringType())),
    StructField("label", StringType()),
    StructField("label_values_or_threshold", ArrayType(StringType())),
    StructField("facet", ArrayType(StructType([
        StructField("name_or_index", StringType()),
        StructField("value_or_threshold", ArrayType(StringType()))]))),
    StructField("methods", StructType([
        StructField("pre_training_bias", StructType([
            StructField("methods", ArrayType(StringType()))])),
        StructField("report", StructType([
            StructField("name", StringType()),
            StructField("title", StringType())])),
    ])),
])


# The pre-training bias analysis configuration of the review
# data (same for the unbalanced and the balanced data set).
DEFAULT_BIAS_CONFIG = {
    "dataset_type": "text/csv",
    "headers": ["sentiment", "review_body", "product_category"],
    "label": "sentiment",
    "label_values_or_threshold": [1],
    "facet": [{"name_or_index": "product_category"}],
    "methods": {
        "pre_training_bias": {"methods": ["CI", "DPL", "KL", "JS", "LP", "TVD", "KS"]},
        "report": {"name": "report", "title": "Analysis Report"},
    },
}


def write_bias_config(spark: SparkSession, path: str, config: dict | None = None,
                      pretty: bool = True) -> str:
    """Write a configuration object as a single JSON file (via Spark, so the
    path may be any Hadoop file system URI)."""
    import json
    text = json.dumps(config or DEFAULT_BIAS_CONFIG, indent=4 if pretty else None)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


@dataclass
class BiasConfig:
    label: str
    positive_values: list
    facets: list
    methods: list
    headers: list = field(default_factory=list)
    dataset_type: str = "text/csv"
    report_name: str = "report"
    report_title: str = "Analysis Report"
    #: Per facet the values (or the threshold) that make its group, None: each value in turn.
    facet_values: list = field(default_factory=list)


def _plain(spelling: str):
    """A whole number as such, anything else as it is spelled."""
    return int(spelling) if spelling.lstrip("-").isdecimal() and str(int(spelling)) == spelling else spelling


def read_bias_config(spark: SparkSession, path: str) -> BiasConfig:
    """One JSON object per file; ``multiLine`` reads both layouts."""
    rows = (spark.read.option("multiLine", "true").schema(BIAS_CONFIG_SCHEMA)
            .json(path).limit(2).collect())
    if len(rows) != 1:
        raise ValueError(f"expected one configuration object in {path}, got {len(rows)}")
    r = rows[0]
    methods = r["methods"]
    pre = (methods["pre_training_bias"]["methods"]
           if methods and methods["pre_training_bias"] else None)
    report = methods["report"] if methods else None
    return BiasConfig(
        label=r["label"],
        positive_values=[_plain(v) for v in (r["label_values_or_threshold"] or [])],
        facets=[f["name_or_index"] for f in (r["facet"] or [])],
        facet_values=[f["value_or_threshold"] or None for f in (r["facet"] or [])],
        methods=list(pre or []),
        headers=list(r["headers"] or []),
        dataset_type=r["dataset_type"] or "text/csv",
        report_name=(report["name"] if report else None) or "report",
        report_title=(report["title"] if report else None) or "Analysis Report",
    )
