"""Schemas of the engine's tables."""

IMAGE = "struct<height:int,width:int,n_channels:int,mode:int,data:binary>"
BOX = "struct<x0:int,y0:int,x1:int,y1:int>"

PAGE_SCHEMA = f"source_path string, filename string, stem string, extension string, data_type string, page_num int, total_pages int, page_key string, text string, image {IMAGE}, error string"
CROP_SCHEMA = f"page_key string, crop_idx int, image {IMAGE}, angle int, is_composite boolean"
REGION_SCHEMA = f"page_key string, region_idx int, region_id string, label string, bbox {BOX}"
CHUNK_SCHEMA = "page_key string, chunk_idx int, start int, end int, chunk string"
ENTITY_SCHEMA = "page_key string, label string, start int, end int, surface string, stage string"
REPLY_SCHEMA = "page_key string, chunk_idx int, task string, raw_content string"
AUDIT_SCHEMA = "page_key string, clean_ocr string, roberta_only string, final_llm_scrubbed string, redacted_entities array<string>"
META_SCHEMA = "page_key string, stem string, page int, rotated boolean, composite boolean, removed_info array<string>"
SCORE_SCHEMA = "page_key string, tp long, fn long, fp long, tn long"
LEAK_SCHEMA = "page_key string, leaked_phi string, context string"
PREPROCESS_SCHEMA = "original_file string, detected_rotation int, was_composite_spread boolean, pages_output int, generated_files array<string>, status string, error string"
