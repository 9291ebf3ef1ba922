"""Schemas of the control and canonical tables: fixed values throughout, since other
programs read these tables by their column names and types."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type, …``; needs no running session."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LANDING_METADATA = _struct(
    "snapshot_date string, source_file string, source_path string, "
    "relative_path string, landing_bucket string, landing_key string, "
    "file_extension string, file_size_bytes bigint, file_hash string, "
    "discovered_at timestamp, upload_status string, uploaded_at timestamp, "
    "error_message string"
)

EXECUTION_LOG = _struct(
    "execution_id string, source_file string, snapshot_date string, "
    "source_type string, dataset_name string, file_hash string, status string, "
    "start_time timestamp, end_time timestamp, duration_seconds double, "
    "retry_count int, bronze_path string, error_message string"
)

MANIFEST = _struct(
    "source_file string, snapshot_date string, source_type string, "
    "dataset_name string, file_hash string, bronze_path string, "
    "pipeline_version string, processed_at timestamp"
)
MANIFEST_KEYS = ["source_file", "snapshot_date", "file_hash"]

QUALITY_LOG = _struct(
    "logged_at timestamp, source_file string, snapshot_date string, "
    "source_path string, issue_type string, issue_description string, "
    "line_number bigint, severity string"
)

GROUP_OUTCOME = _struct(
    "read_path string, ok boolean, group_start timestamp, group_end timestamp, "
    "retries int, group_error string"
)

NACT_CONTRACTS = _struct(
    "nact_internal_id string, contract_number_raw string, contract_number string, "
    "supplier_cnpj string, supplier_name string, operation_location string, "
    "supplier_role string, competence string, compliance_score string, "
    "pending_issues_summary string, source_vendor string, source_layout string, "
    "canonical_entity string, snapshot_date string, processed_at string"
)

SGC_CONTRACTS = _struct(
    "contract_number_raw string, contract_number string, supplier_name string, "
    "contract_description string, project_area string, currency string, "
    "total_value string, po_value string, total_tacs string, total_claims string, "
    "total_adjustments string, total_advance string, measured_value string, "
    "remaining_to_measure string, contractual_block string, "
    "remaining_to_pay string, remaining_percentage string, start_date string, "
    "end_date string, remaining_days string, manager_name string, "
    "administrator_name string, inspector_name string, "
    "measurement_inspector_name string, source_system string, "
    "source_dataset string, canonical_entity string, snapshot_date string, "
    "processed_at string"
)

BRONZE_PARTITIONS = ["source_type", "dataset", "snapshot_date", "file_key"]
