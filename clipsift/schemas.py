"""Schemas of the layered tables, given on read so that no inference pass is needed."""

from __future__ import annotations

# Field names and types of the stored records.
LABELED_POST = (
    "video_id string, split string, label_raw string, label string, "
    "original_filename string, source string"
)
CRAWLED_POST = (
    "video_id string, url string, timestamp double, source string, description string, "
    "stats map<string,string>, tags array<string>"
)
CRAWLED_PAGE = (
    "likes string, comments string, shares string, bookmarks string, views string, "
    "description string, musicTitle string, date string, author string, tags array<string>, "
    "videoUrl string, comments_tree array<struct<text:string,replies:array<struct<text:string>>>>"
)
INGESTION_EVENT = (
    "video_id string, source string, raw_path string, timestamp double, "
    "metadata map<string,string>"
)
PREDICTION = (
    "video_id string, label string, label_id int, confidence double, "
    "probabilities map<string,double>, processing_time double, source string, "
    "raw_path string, ingested_at timestamp, timestamp double"
)
PREDICTION_LINE = (
    "video_id string, label string, confidence double, processing_time_ms double, "
    "source string, timestamp string"
)
ANNOTATION_TASK = (
    "id bigint, data struct<video:string>, "
    "annotations array<struct<result:array<struct<value:struct<choices:array<string>>>>>>"
)
GOLD_ROW = (
    "video_id string, video_emb array<float>, audio_emb array<float>, text_emb array<float>, "
    "metadata_numeric array<float>, label bigint"
)
EVAL_RESULT = "model string, label int, pred int, prob double"
