"""Streaming extraction and wildcard-path flattening of semi-structured messages."""

from pathloom.functions.types import build_schema, data_type, permissive_cast
from pathloom.operators.extract import extract_csv, extract_json, infer_all, infer_schema, load_mapping, split_rejects
from pathloom.operators.flatten import GroupTables, flatten_groups, flatten_paths
from pathloom.operators.pathmap import path_map, prune_paths
from pathloom.plans.templates import plan_groups
from pathloom.sources.readers import read_csv, read_json, read_parquet, read_stream
from pathloom.streaming.job import JobSpec, run
from pathloom.streaming.sinks import pack_rows, unpack_rows, write_stream, write_with_rejects

__all__ = [
    "GroupTables",
    "JobSpec",
    "build_schema",
    "data_type",
    "extract_csv",
    "extract_json",
    "flatten_groups",
    "flatten_paths",
    "infer_all",
    "infer_schema",
    "load_mapping",
    "pack_rows",
    "path_map",
    "permissive_cast",
    "plan_groups",
    "prune_paths",
    "read_csv",
    "read_json",
    "read_parquet",
    "read_stream",
    "run",
    "split_rejects",
    "unpack_rows",
    "write_stream",
    "write_with_rejects",
]
