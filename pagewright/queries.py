"""The engine's operators as queries over the test tables: name -> function of (session, folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import SAFE_WORDS, TASKS
from .functions import geometry, replies, strings
from .operators import boxes, chunking, detection, documents, layout, pages, redaction, scoring
from .sinks import files
from .streaming.ingest import windowed

PAGE_WIDTH, PAGE_HEIGHT = 1240, 1754


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _audit(spark: SparkSession, folder: str, *fields: str) -> DataFrame:
    return pages.last_written(table(spark, folder, "audit_trail").select("page_key", "written_at", *fields), fields=fields)


# ---- keys, routing, filters


def page_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "page_metadata").select("page_key", "stem", "page").distinct()
    stem = F.coalesce("stem", pages.doc_stem(F.col("page_key")))
    return rows.select("page_key", pages.page_key(stem, F.col("page")).alias("made"), stem.alias("doc_stem")).distinct()


def file_routing(spark: SparkSession, folder: str) -> DataFrame:
    rows = pages.routed(table(spark, folder, "preprocess_audit").select("original_file").distinct(), "original_file")
    return rows.select("original_file", "stem", "extension", "family")


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    rows = pages.routed(table(spark, folder, "preprocess_audit"), "original_file")
    return rows.where((F.col("family") == "image") & F.col("original_file").contains("LS")).select("original_file", "status")


def page_subset(spark: SparkSession, folder: str) -> DataFrame:
    return pages.only_pages(table(spark, folder, "page_metadata"), pages.page_filter("1, 3,5")).select("page_key", "page")


def numbered_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", F.coalesce("source", F.lit("unknown")).alias("stem"))
    rows = pages.numbered(rows, ["stem"], [F.col("doc_id")])
    return rows.select("doc_id", pages.page_key(F.col("stem"), F.col("page_num")).alias("page_key"))


def last_written(spark: SparkSession, folder: str) -> DataFrame:
    return _audit(spark, folder, "clean_ocr", "final_llm_scrubbed")


def stem_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "page_metadata")
    return rows.groupBy(pages.doc_stem(F.col("page_key")).alias("stem")).agg(F.countDistinct("page_key").alias("n_pages"), F.sum(F.size("removed_info").cast("long")).alias("n_removed"))


# ---- texts


def merged_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents.merged_documents(_audit(spark, folder, "final_llm_scrubbed"), "final_llm_scrubbed")


def merged_lexicographic(spark: SparkSession, folder: str) -> DataFrame:
    return documents.merged_documents(_audit(spark, folder, "final_llm_scrubbed"), "final_llm_scrubbed", lexicographic=True)


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    return files.page_files(_audit(spark, folder, "final_llm_scrubbed"), "final_llm_scrubbed")


def strip_markup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "corpus_dict").select("page_key", "raw_text").distinct()
    return rows.select("page_key", "raw_text", strings.strip_markup(F.col("raw_text")).alias("text"))


def parsed_markup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "corpus_dict").select("page_key", "raw_text").distinct()
    return rows.select("page_key", documents.parsed_text(F.col("raw_text")).alias("text"))


def ocr_tree_text(spark: SparkSession, folder: str) -> DataFrame:
    words = F.transform(F.split("clean_ocr", "\n"), lambda line: F.struct(F.transform(strings.split_words(line), lambda w: F.struct(w.alias("value"))).alias("words")))
    tree = F.array(F.struct(F.array(F.struct(words.alias("lines"))).alias("blocks")))
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    return rows.select("page_key", documents.tree_text(tree).alias("text"))


def content_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text is not null")
    blocks = F.transform(F.split("text", "\n\n"), lambda x: F.struct(F.when(F.length(x) % 2 == 0, x).alias("content"), x.alias("text")))
    return rows.select("doc_id", documents.block_text(blocks).alias("text"))


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr", "final_llm_scrubbed")
    crops = rows.select("page_key", F.posexplode(F.array("clean_ocr", "final_llm_scrubbed")).alias("crop_idx", "text"))
    return documents.page_texts(crops)


def word_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    grams = strings.ngrams(strings.word_tokens(F.lower("text")), 3)
    return table(spark, folder, "documents").where("text is not null").select("doc_id", F.size(grams).alias("n_grams"), F.size(F.array_distinct(grams)).alias("n_distinct"))


# ---- chunks and questions


def chunks_stage1(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    return chunking.chunks(rows, chunking.stage1_spans()(F.col("clean_ocr")), "clean_ocr", stripped=False).select("page_key", "chunk_idx", "start", "end")


def chunks_stage1_native(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    return chunking.chunks(rows, chunking.blank_spans_native(F.col("clean_ocr")), "clean_ocr", stripped=False).select("page_key", "chunk_idx", "start", "end")


def chunks_stage2(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    return chunking.chunks(rows, chunking.stage2_spans()(F.col("clean_ocr")), "clean_ocr").select("page_key", "chunk_idx", "start", "end")


def chunk_questions(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null").withColumnRenamed("clean_ocr", "text")
    asked = chunking.with_tasks(chunking.chunks(rows, chunking.stage2_spans()(F.col("text"))), TASKS)
    return asked.groupBy("task").agg(F.count("*").alias("questions"), F.countDistinct("page_key").alias("pages"))


# ---- redaction


def rule_ner(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    found = rows.select("page_key", "clean_ocr", F.posexplode(redaction.rule_entities(F.col("clean_ocr"))).alias("idx", "e"))
    return found.select("page_key", "idx", "e.label", F.substring("clean_ocr", F.col("e.start") + 1, F.col("e.end") - F.col("e.start")).alias("surface"))


def span_redacted(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").where("clean_ocr is not null")
    cut = redaction.spliced(F.col("clean_ocr"), redaction.removable(redaction.rule_entities(F.col("clean_ocr"))))
    return rows.select("page_key", cut.alias("s")).select("page_key", "s.text", F.array_join("s.removed", "|").alias("removed"))


def _raw_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies as a model words them: bare, fenced, within prose, or broken, by reply_id."""
    rows = table(spark, folder, "patient_data_extractor").distinct()
    body = F.to_json(F.struct("contains_pii", "extracted_identifiers"))
    kind = F.col("reply_id") % 4
    raw = F.when(kind == 0, body).when(kind == 1, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```\nDone {x}"))).when(kind == 2, F.concat(F.lit("I found "), body, F.lit(" here."))).otherwise(F.concat(F.lit("{"), body))
    return rows.withColumn("raw_content", raw)


def reply_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    found = _raw_replies(spark, folder).withColumn("ids", replies.identifiers(F.col("raw_content")))
    return found.select("reply_id", F.col("ids").isNotNull().alias("accepted"), F.coalesce(F.array_join("ids", "|"), F.lit("")).alias("identifiers"))


def _harvested(spark: SparkSession, folder: str) -> DataFrame:
    return redaction.harvested(table(spark, folder, "patient_data_extractor"), F.col("extracted_identifiers"))


def harvested(spark: SparkSession, folder: str) -> DataFrame:
    return _harvested(spark, folder).select("page_key", F.array_join("identifiers", "|").alias("identifiers"))


def identifier_words(spark: SparkSession, folder: str) -> DataFrame:
    words = redaction.identifier_words(F.col("identifiers"), SAFE_WORDS)
    return _harvested(spark, folder).select("page_key", F.array_join(words, "|").alias("words"))


def word_redacted(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "roberta_only").where("roberta_only is not null").join(_harvested(spark, folder), "page_key", "left")
    done = redaction.words_replaced(F.col("roberta_only"), redaction.identifier_words(F.col("identifiers"), SAFE_WORDS))
    return rows.select("page_key", done.alias("s")).select("page_key", "s.text", F.array_join("s.removed", "|").alias("removed"))


def audit_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr").withColumnRenamed("clean_ocr", "text")
    made = redaction.audit_records(rows.join(_harvested(spark, folder), "page_key", "left"))
    return made.withColumn("redacted_entities", F.array_join("redacted_entities", "|"))


def redacted_entities(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "audit_trail").select("page_key", F.explode("redacted_entities").alias("e"))
    two = table(spark, folder, "patient_data_extractor").select("page_key", F.explode("extracted_identifiers").alias("e"))
    both = one.unionByName(two).where("e is not null").distinct()
    return both.groupBy("page_key").agg(F.array_join(F.array_sort(F.collect_list("e")), "|").alias("entities"))


# ---- scoring


def _pages_and_terms(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    terms = table(spark, folder, "patient_data_extractor").select("page_key", F.explode("extracted_identifiers").alias("term"))
    return _audit(spark, folder, "clean_ocr", "final_llm_scrubbed"), terms


def truth_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return rows.select("page_key").join(scoring.page_terms(terms), "page_key").groupBy("page_key").agg(F.count("*").alias("n_terms"))


def truth_missing(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return rows.select("page_key").join(scoring.page_terms(terms), "page_key", "left_anti")


def term_found(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return scoring.exact_targets(rows, terms).select("page_key", "target", F.contains("final", "target").alias("leaked"))


def page_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return scoring.scores(rows, terms, scoring.exact_targets(rows, terms))


def scorecard(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.scorecard(page_scores(spark, folder))


def leak_report(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return files.leak_report(scoring.leaks(scoring.exact_targets(rows, terms)))


def fuzzy_spellings(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return scoring.fuzzy_targets(rows, terms).select("page_key", "target")


def scorecard_fuzzy(spark: SparkSession, folder: str) -> DataFrame:
    rows, terms = _pages_and_terms(spark, folder)
    return scoring.scorecard(scoring.scores(rows, terms, scoring.fuzzy_targets(rows, terms)))


# ---- reports


def debug_report(spark: SparkSession, folder: str) -> DataFrame:
    meta = table(spark, folder, "page_metadata").select("page_key", "stem", "page", "rotated", "composite").distinct()
    audit = _audit(spark, folder, "redacted_entities")
    return files.debug_report(meta, audit)


def preprocess_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "preprocess_audit")
    composite = F.coalesce("was_composite_spread", F.lit(False))
    return rows.groupBy("status", F.coalesce("detected_rotation", F.lit(-1)).alias("rotation"), composite.alias("composite")).agg(F.count("*").alias("files"), F.sum(F.coalesce("pages_output", F.lit(0)).cast("long")).alias("pages"))


def split_file_names(spark: SparkSession, folder: str) -> DataFrame:
    return files.split_names(table(spark, folder, "preprocess_audit").where("status = 'SUCCESS' and pages_output > 0").select("original_file", "pages_output").distinct())


def composite_files(spark: SparkSession, folder: str) -> DataFrame:
    names = split_file_names(spark, folder)
    whole = names.withColumn("composite", F.count("*").over(Window.partitionBy("original_file")) > 1)
    return whole.select("original_file", "composite").distinct()


def sanitised_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "page_metadata").select(F.explode("removed_info").alias("label")).distinct()
    return rows.select("label", strings.sanitised_label(F.col("label")).alias("clean"))


def list_cells(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_metadata").select("page_key", strings.list_cell(F.col("removed_info")).alias("cell")).distinct()


def redacted_words(spark: SparkSession, folder: str) -> DataFrame:
    rows = _audit(spark, folder, "clean_ocr", "final_llm_scrubbed").where("clean_ocr is not null")
    before, after = (F.array_distinct(strings.word_tokens(F.lower(F.coalesce(c, F.lit(""))))) for c in ("clean_ocr", "final_llm_scrubbed"))
    return rows.select("page_key", F.array_join(F.array_sort(F.array_except(before, after)), " ").alias("gone"))


def special_free(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as a model gives them back: with the prompt before them and special tokens around them."""
    rows = table(spark, folder, "documents").select("doc_id", F.concat(F.lit("<s>"), F.col("source"), F.lit(": ")).alias("prompt"), F.col("text").alias("said"))
    said = F.concat(F.when(F.col("doc_id") % 2 == 0, F.col("prompt")).otherwise(""), F.lit("<|start|> "), F.col("said"), F.lit("</s><pad><|end of text|>"))
    return rows.select("doc_id", strings.without_special_tokens(said, F.coalesce("prompt", F.lit(""))).alias("text"))


def page_number_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of page numbers such as a user types, one of them malformed now and then."""
    rows = table(spark, folder, "page_metadata").groupBy(pages.doc_stem(F.col("page_key")).alias("stem")).agg(F.array_sort(F.collect_set("page")).alias("p"))
    typed = F.concat(F.array_join("p", ", "), F.when(F.size("p") % 3 == 0, ",x").otherwise(""))
    return rows.select("stem", strings.int_list(typed).alias("n")).select("stem", F.array_join("n", "|").alias("numbers"))


def ground_truth_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """The terms of ground-truth files in their several shapes, by reply_id."""
    rows = table(spark, folder, "patient_data_extractor").where("size(extracted_identifiers) > 0").select("reply_id", F.filter("extracted_identifiers", lambda x: x.isNotNull()).alias("e")).where("size(e) > 0").distinct()
    kind = F.col("reply_id") % 4
    raw = F.when(kind == 0, F.to_json(F.struct(F.col("e").alias("ID")))).when(kind == 1, F.to_json(F.struct(F.col("e")[0].alias("ID")))).when(kind == 2, F.to_json(F.struct(F.col("e")[0].alias("name"), F.lit(3).alias("n")))).otherwise(F.to_json(F.transform("e", lambda x: F.struct(x.alias("ID")))))
    return rows.select("reply_id", F.array_join(scoring.ground_truth_terms(raw), "|").alias("terms")).distinct()


def control_free(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", strings.control_to_space(F.col("text")).alias("text"))


# ---- layout


def _boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes by integer arithmetic from order lines: a page is an order."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    x0, y0 = (F.col("l_partkey") * 7 % 1100).cast("int"), (F.col("l_suppkey") * 13 % 1600).cast("int")
    kinds = F.array(*[F.lit(x) for x in ("Text", "PageHeader", "Table", "PageFooter", "SectionHeader")])
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("page_key"),
        (F.row_number().over(order) - 1).alias("idx"),
        x0.alias("x0"),
        y0.alias("y0"),
        (x0 + 20 + F.col("l_quantity").cast("int") * 8).alias("x1"),
        (y0 + 10 + (F.col("l_partkey") % 50).cast("int")).alias("y1"),
        F.element_at(kinds, (F.col("l_linenumber") % 5).cast("int") + 1).alias("label"),
    )


def _box():
    return geometry.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))


def padded_boxes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _boxes(spark, folder).withColumn("b", geometry.padded(_box(), 6, F.lit(PAGE_WIDTH), F.lit(PAGE_HEIGHT)))
    return rows.select("page_key", "idx", "b.x0", "b.y0", "b.x1", "b.y1").where("x1 > x0 and y1 > y0")


def region_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = boxes.region_ids(_boxes(spark, folder), [F.col("y0"), F.col("idx")], "region_%02d_%s")
    return rows.select("page_key", "idx", "region_id")


def content_blocks_in_order(spark: SparkSession, folder: str) -> DataFrame:
    rows = boxes.region_ids(_boxes(spark, folder), [*boxes.reading_order(F.struct("y0", "x0")), F.col("idx")], "block_%03d", with_label=False)
    return pages.without_empty_labels(rows).select("page_key", "idx", "region_id", "label")


def large_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Regions of at least half a per cent of their page that haven't collapsed."""
    rows = _boxes(spark, folder).where("x1 > x0 and y1 > y0")
    return rows.where(geometry.area(_box()) >= PAGE_WIDTH * PAGE_HEIGHT * 0.005).select("page_key", "idx", geometry.area(_box()).alias("area"))


def line_heights(spark: SparkSession, folder: str) -> DataFrame:
    return _boxes(spark, folder).groupBy("page_key").agg(F.median(F.col("y1") - F.col("y0")).alias("median_height"))


def surviving_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.without_swallowed(_boxes(spark, folder))


def paragraph_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.paragraphs(_boxes(spark, folder))


def _sized(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"width": F.lit(PAGE_WIDTH), "height": F.lit(PAGE_HEIGHT)})


def line_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Lines given as polygons of four corners, a little aslant."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), y.alias("y"))
    points = F.array(corner("x0", F.col("y0") + 2), corner("x1", F.col("y0")), corner("x1", F.col("y1")), corner("x0", F.col("y1") - 1))
    return layout.line_regions(_sized(_boxes(spark, folder)).withColumn("points", points))


def paragraph_regions(spark: SparkSession, folder: str) -> DataFrame:
    return layout.paragraph_regions(_sized(_boxes(spark, folder)))


def block_regions(spark: SparkSession, folder: str) -> DataFrame:
    return layout.block_regions(_sized(_boxes(spark, folder)))


def _found_in_strips(spark: SparkSession, folder: str) -> DataFrame:
    """What a detector said about strips: a strip's number follows from the line, its corners from the box."""
    rows = _sized(_boxes(spark, folder)).withColumn("y_offset", F.col("idx") % 3 * layout.STEP)
    strip = F.least(F.lit(layout.STRIP), F.col("height") + 2 * layout.BORDER - F.col("y_offset"))
    quad = F.array(*[c.cast("double") for c in (F.col("x0") - 30, F.col("y0") % 900 - 20, F.col("x1") + F.lit(0.5), F.col("y0") % 900, F.col("x1"), F.col("y0") % 900 + 90, F.col("x0"), F.col("y0") % 900 + 80)])
    return rows.select("page_key", "idx", "y_offset", (F.col("width") + 2 * layout.BORDER).alias("strip_width"), strip.cast("int").alias("strip_height"), "width", "height", quad.alias("quad"), F.concat("label", F.lit(": a/b?")).alias("label"))


def strip_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return layout.restored(_found_in_strips(spark, folder))


def mined_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return layout.mined(_found_in_strips(spark, folder))


def page_hulls(spark: SparkSession, folder: str) -> DataFrame:
    corners = F.flatten(F.collect_list(F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")))))
    rows = _boxes(spark, folder).groupBy("page_key").agg(geometry.hull(corners).alias("b"))
    return rows.select("page_key", "b.x0", "b.y0", "b.x1", "b.y1")


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("page_key"), (F.col("o_custkey") % 3000 + 200).cast("int").alias("width"), (F.col("o_orderkey") % 2500 + 200).cast("int").alias("height"))
    return rows


def page_strips(spark: SparkSession, folder: str) -> DataFrame:
    return boxes.strips(_sizes(spark, folder).withColumn("height", F.col("height") + 120))


def fitted_sizes(spark: SparkSession, folder: str) -> DataFrame:
    w, h = geometry.fitted_size(F.col("width"), F.col("height"), 896)
    first, end = geometry.search_band(F.col("width"))
    return _sizes(spark, folder).select("page_key", w.alias("w"), h.alias("h"), first.alias("band_first"), end.alias("band_end"))


def spread_gate(spark: SparkSession, folder: str) -> DataFrame:
    asked = lambda broad: broad.select("page_key", (F.col("width") > 2 * F.col("height")).alias("is_composite"))
    return detection.spreads(_sizes(spark, folder), asked)


def gutters(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", geometry.gutter(F.col("embedding")).alias("gutter"))


def patch_boxes(spark: SparkSession, folder: str) -> DataFrame:
    return detection.patches(_sizes(spark, folder))


# ---- orientation


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    """Orientation readings as texts from events: a page is a user, a patch the order of its event."""
    rows = table(spark, folder, "events")
    text = F.concat(F.lit("Rotate: "), (F.col("event_id") % 5 * 90).cast("string"), F.lit("\nOrientation confidence: "), F.col("value").cast("decimal(12,2)").cast("string"))
    patch = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return rows.select(F.col("user_id").cast("string").alias("page_key"), patch.alias("patch"), strings.orientation_angle(text).alias("angle"), strings.orientation_confidence(text).alias("confidence"))


def first_confident(spark: SparkSession, folder: str) -> DataFrame:
    return detection.first_confident(_readings(spark, folder))


def page_angles(spark: SparkSession, folder: str) -> DataFrame:
    readings = _readings(spark, folder)
    return detection.angles(readings.select("page_key").distinct(), readings)


def sure_page_angles(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a bound that leaves pages to later patches, or undecided."""
    readings = _readings(spark, folder)
    return detection.angles(readings.select("page_key").distinct(), readings, least=480.0)


def _reply(spark: SparkSession, folder: str, field: str, values: tuple[str, ...]) -> DataFrame:
    """One reply for each event, with the field's value in one of several spellings, by event_id."""
    spelt = F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("event_id") % len(values)).cast("int") + 1)
    raw = F.concat(F.lit('Well:\n{"thinking": "seen\n", "'), F.lit(field), F.lit('": '), spelt, F.lit("} so."))
    return table(spark, folder, "events").select("event_id", raw.alias("raw"))


def rotation_replies(spark: SparkSession, folder: str) -> DataFrame:
    rows = _reply(spark, folder, "rotation_angle", ("90", '"180"', "270.0", "90.5", "45", "null", "true", '" 90 "', '"up"'))
    return rows.select("event_id", replies.rotation_angle(F.col("raw")).alias("angle"))


def spread_replies(spark: SparkSession, folder: str) -> DataFrame:
    rows = _reply(spark, folder, "is_composite_spread", ("true", '"yes"', "1", "0", "2", '"<boolean>"', '"on"', "null", "false"))
    return rows.select("event_id", replies.is_spread(F.col("raw")).alias("spread"))


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = windowed(table(spark, folder, "events"))
    return rows.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("mean_value", 6).alias("mean_value"))


_HELPERS = {"table"}
QUERIES = {name: f for name, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not name.startswith("_") and name not in _HELPERS}
