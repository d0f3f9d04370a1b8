"""Declared schemas of the nine persistent tables."""

from pyspark.sql.types import _parse_datatype_string as _parse

_DDL = {
    "documents": "doc_id string, source string, native_id string, title string, abstract string, published_date date, year int, time_slice string, url string, venue string, authors array<string>, institutions array<string>, concepts array<string>, citation_count int, steepv string, scan_frame_key string, tone double, raw_path string, collected_at timestamp, run_id string",
    "vectors": "content_hash string, backend string, dimensions int, vector array<double>, created_at timestamp",
    "strategy_refs": "ref_id string, ref_type string, code string, label string, text string, source_document string, lexicon array<string>, weight double, created_at timestamp",
    "topics": "topic_id string, run_id string, label string, terms array<struct<term:string,weight:double>>, document_count int, first_slice string, last_slice string, burst_slices array<string>, novelty double, growth double, coherence double, impact double, uncertainty double, emergence_score double, burst_weight double, cagr double, maturity double, avg_proportion double, horizon string, signal_class string, created_at timestamp",
    "topic_documents": "topic_id string, doc_id string, similarity double",
    "topic_timeseries": "topic_id string, time_slice string, doc_count int, proportion double, in_burst boolean",
    "topic_scores": "topic_id string, run_id string, strategic_fit double, best_objective string, best_objective_sim double, critical_tech string, asset_leverage double, best_asset string, opportunity_index double, index_components map<string,double>, index_suppressed boolean, composite_rank_score double, rank int, fit_quadrant string",
    "pipeline_runs": "id long, run_id string, stage string, status string, message string, config_snapshot string, started_at timestamp, finished_at timestamp, records_in int, records_out int",
    "collection_log": "run_id string, source string, scan_frame_key string, status string, records int, message string, logged_at timestamp",
}


def schema(table: str):
    return _parse(_DDL[table])


TABLES = tuple(_DDL)
KEYS = {"documents": ["doc_id"], "vectors": ["content_hash", "backend"], "strategy_refs": ["ref_id"], "topics": ["topic_id"], "topic_documents": ["topic_id", "doc_id"], "topic_timeseries": ["topic_id", "time_slice"], "topic_scores": ["topic_id", "run_id"]}
