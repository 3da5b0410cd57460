"""Readers of files, images, manifests, attributes and chunks; writers of their outputs."""

from .images import read_named
from .readers import PRESETS, count_images, filter_images, list_files, list_in_tasks, new_files, newest_new_file, read_attributes, read_chunks, read_images, read_json_doc, read_manifest, read_snapshot, save_snapshot
from .versions import ChunkTable
from .writers import write_attributes, write_chunk, write_chunks, write_dataset, write_files, write_manifests, write_records, write_summary

__all__ = [
    "ChunkTable", "PRESETS", "count_images", "filter_images", "list_files", "list_in_tasks", "new_files", "newest_new_file", "read_attributes", "read_chunks", "read_images", "read_json_doc",
    "read_manifest", "read_named", "read_snapshot", "save_snapshot", "write_attributes", "write_chunk", "write_chunks", "write_dataset", "write_files", "write_manifests", "write_records", "write_summary",
]
