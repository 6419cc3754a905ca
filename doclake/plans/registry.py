"""Registered queries: name -> (spark builder, DuckDB SQL builder or None)."""

from __future__ import annotations

import functools

from doclake.plans import queries_changes as C
from doclake.plans import queries_extract as X
from doclake.plans import queries_forms as FM
from doclake.plans import queries_ingest as G
from doclake.plans import queries_pages as PG
from doclake.plans import queries_pii as P
from doclake.plans import queries_state as Q
from doclake.plans import queries_streams as ST

QUERIES = {
    "pii_summary": (P.pii_summary, P.pii_summary_sql),
    "pii_detections": (P.pii_detections, P.pii_detections_sql),
    "pii_pages_html": (P.pii_pages_html, P.pii_pages_html_sql),
    "keys_parse": (G.keys_parse, G.keys_parse_sql),
    "ingest_documents": (G.ingest_documents, G.ingest_documents_sql),
    "ingest_pages": (G.ingest_pages, G.ingest_pages_sql),
    "ingest_pages_lexical": (G.ingest_pages_lexical, G.ingest_pages_lexical_sql),
    "ingest_rejects": (G.ingest_rejects, G.ingest_rejects_sql),
    "envelope_decode": (G.envelope_decode, G.envelope_decode_sql),
    "file_moves": (G.file_moves, G.file_moves_sql),
    "folder_counts": (G.folder_counts, G.folder_counts_sql),
    "doc_status_view": (Q.doc_status_view, Q.doc_status_view_sql),
    "doc_list_page": (Q.doc_list_page, Q.doc_list_page_sql),
    "doc_list_next": (Q.doc_list_next, Q.doc_list_next_sql),
    "doc_list_third": (Q.doc_list_third, Q.doc_list_third_sql),
    "newest_per_status": (Q.newest_per_status, Q.newest_per_status_sql),
    "doc_files_view": (Q.doc_files_view, Q.doc_files_view_sql),
    "doc_timeline": (Q.doc_timeline, Q.doc_timeline_sql),
    "timeline_guide": (Q.timeline_guide, Q.timeline_guide_sql),
    "timeline_summary": (Q.timeline_summary, Q.timeline_summary_sql),
    "timeline_text": (Q.timeline_text, Q.timeline_text_sql),
    "status_counts": (Q.status_counts, Q.status_counts_sql),
    "failure_rates": (Q.failure_rates, Q.failure_rates_sql),
    "ocr_rollup": (Q.ocr_rollup, Q.ocr_rollup_sql),
    "retention": (Q.retention, Q.retention_sql),
    "error_categories": (Q.error_categories, Q.error_categories_sql),
    "doc_lookup": (Q.doc_lookup, Q.doc_lookup_sql),
    "input_guards": (Q.input_guards, Q.input_guards_sql),
    "workflow_steps": (Q.workflow_steps, Q.workflow_steps_sql),
    "document_workflow": (Q.document_workflow, Q.document_workflow_sql),
    "doc_status_steps": (Q.doc_status_steps, Q.doc_status_steps_sql),
    "doc_full": (Q.doc_full, Q.doc_full_sql),
    "timeline_history": (Q.timeline_history, Q.timeline_history_sql),
    "timeline_history_contains": (Q.timeline_history_contains, Q.timeline_history_contains_sql),
    "page_text_lines": (PG.page_text_lines, PG.page_text_lines_sql),
    "page_text_grouped": (PG.page_text_grouped, PG.page_text_grouped_sql),
    "page_text_sink": (PG.page_text_sink, PG.page_text_sink_sql),
    "combined_text": (PG.combined_text, PG.combined_text_sql),
    "combined_offsets": (PG.combined_offsets, PG.combined_offsets_sql),
    "pii_boxes": (PG.pii_boxes, PG.pii_boxes_sql),
    "pii_boxes_join": (PG.pii_boxes_join, PG.pii_boxes_sql),
    "masked_text": (PG.masked_text, PG.masked_text_sql),
    "state_fold": (C.state_fold, C.state_fold_sql),
    "state_transitions": (C.state_transitions, C.state_transitions_sql),
    "state_upsert": (C.state_upsert, C.state_fold_sql),
    "change_detect": (C.change_detect, C.change_detect_sql),
    "page_batches": (C.page_batches, C.page_batches_sql),
    "page_batches_6h": (C.page_batches_6h, C.page_batches_6h_sql),
    "llm_requests": (X.llm_requests, X.llm_requests_sql),
    "llm_pending": (X.llm_pending, X.llm_pending_sql),
    "llm_outcomes": (X.llm_outcomes, X.llm_outcomes_sql),
    "llm_second_pass": (X.llm_second_pass, X.llm_second_pass_sql),
    "llm_results": (X.llm_results, X.llm_results_sql),
    "extraction_typed": (X.extraction_typed, X.extraction_typed_sql),
    "extraction_typed_all": (X.extraction_typed_all, X.extraction_typed_all_sql),
    "extraction_check": (X.extraction_check, X.extraction_check_sql),
    "form_detections": (FM.form_detections, FM.form_detections_sql),
    "form_detections_sure": (FM.form_detections_sure, FM.form_detections_sure_sql),
    "pii_result_documents": (FM.pii_result_documents, FM.pii_result_documents_sql),
    "pii_messages": (FM.pii_messages, FM.pii_messages_sql),
    "envelope_sources": (FM.envelope_sources, FM.envelope_sources_sql),
    "doc_prefix": (FM.doc_prefix, FM.doc_prefix_sql),
    "page_siblings": (FM.page_siblings, FM.page_siblings_sql),
    "page_siblings_all": (FM.page_siblings_all, FM.page_siblings_all_sql),
    "page_text_pairs": (FM.page_text_pairs, FM.page_text_pairs_sql),
    "text_key_lists": (FM.text_key_lists, FM.text_key_lists_sql),
    "pii_gate": (X.pii_gate, X.pii_gate_sql),
    "pii_gate_config": (ST.pii_gate_config, X.pii_gate_sql),
    "page_text_parts": (ST.page_text_parts, PG.page_text_lines_sql),
    "stored_results": (ST.stored_results, ST.stored_results_sql),
    "stored_texts": (ST.stored_texts, ST.stored_texts_sql),
    "llm_answers": (ST.llm_answers, ST.llm_answers_sql),
    "stream_page_batches": (ST.stream_page_batches, ST.stream_page_batches_sql),
    "stream_first_bases": (ST.stream_first_bases, ST.stream_first_bases_sql),
    "stream_gate": (ST.stream_gate, ST.stream_gate_sql),
    "stream_state_fold": (ST.stream_state_fold, ST.stream_state_fold_sql),
    "stream_change_feed": (ST.stream_change_feed, C.change_detect_sql),
    "stream_pii_branch": (ST.stream_pii_branch, ST.stream_pii_branch_sql),
    "stream_late_pages": (ST.stream_late_pages, ST.stream_late_pages_sql),
    "stream_counts": (ST.stream_counts, ST.stream_counts_sql),
}


def _utc(fn):
    """Zone-less timestamps are read as UTC throughout (durations, epochs and
    time buckets must not depend on the caller's session zone)."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


QUERIES = {name: (_utc(q[0]), q[1]) for name, q in QUERIES.items()}
