from __future__ import annotations

import datetime as dt

import pytest

AUDIT = "page_key string, clean_ocr string, roberta_only string, final_llm_scrubbed string, redacted_entities array<string>, written_at timestamp"
EXTRACTOR = "reply_id bigint, stem string, page_key string, chunk_idx int, task string, contains_pii boolean, extracted_identifiers array<string>, replied_at timestamp"
CORPUS = "page_key string, raw_text string, transcriber string, transcribed_at timestamp"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc_kind string, page_num int, added_at timestamp"
ITEMS = "item_id bigint, suite string, item_text string, answer string"
META = "page_key string, stem string, page int, rotated boolean, composite boolean, removed_info array<string>, logged_at timestamp"
SCHEMAS = {"audit_trail": AUDIT, "patient_data_extractor": EXTRACTOR, "corpus_dict": CORPUS, "documents": DOCUMENTS, "eval_items": ITEMS, "page_metadata": META}
DAY = dt.datetime(2024, 1, 1)


def audit_row(key, text, final=None, entities=None, day=0):
    return (key, text, None, final, entities, DAY + dt.timedelta(days=day))


@pytest.fixture
def written_tables(spark, tmp_path):
    """Writes small tables and returns their folder; tables that aren't given are empty."""

    def make(**tables) -> str:
        for name, schema in SCHEMAS.items():
            spark.createDataFrame(tables.get(name, []), schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
