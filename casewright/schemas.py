"""Explicit schemas of the stored tables."""

from __future__ import annotations

from casewright.functions.fields import FIELD_TYPES

CASES = (
    "id string NOT NULL, invoice_path string, declaration_path string, royalty_path string, "
    "ingestion_timestamp string, processed bigint, volume_path string"
)
PARSED = (
    "path string, parsed_content string, processed bigint, parsed_content_translated string, "
    "source_language string, translation_applied boolean"
)
CHUNKS = (
    "case_id string, document_id string, document_path string, source_language string, "
    "translation_applied boolean, chunk_id string, text string, id string, "
    + ", ".join(f"{n} {t}" for n, t in FIELD_TYPES.items())
    + ", invoice_path string, declaration_path string, royalty_path string, metadata string"
)
SESSION_MESSAGES = "id bigint, session_id string, message_data string, created_at timestamp"
TRACES = (
    "request_id string, trace_id string, timestamp_ms bigint, execution_time_ms bigint, "
    "status string, tags map<string,string>, request_metadata map<string,string>, "
    "spans array<struct<name:string>>"
)
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
