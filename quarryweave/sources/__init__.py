"""Readers of manifests, bundles and tables, writers of portable artifacts."""

from quarryweave.sources.artifacts import write_edge_pairs, write_jsonl, write_vectors
from quarryweave.sources.bundles import read_bundle, read_sqlite, table_digest, write_bundle
from quarryweave.sources.manifests import read_csv_manifest, read_jsonl_manifest

__all__ = ["read_bundle", "read_csv_manifest", "read_jsonl_manifest", "read_sqlite", "table_digest", "write_bundle", "write_edge_pairs", "write_jsonl", "write_vectors"]
