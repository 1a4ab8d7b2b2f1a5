from __future__ import annotations

import json
import struct
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagewright import backends
from pagewright.config import PipelineConfig
from pagewright.operators.images import packed
from pagewright.plans import cli, pipeline
from pagewright.sinks import files as sinks
from pagewright.sources import files as sources
from pagewright.sources.ground_truth import load_ground_truth
from pagewright.sources.pdf import page_count
from pagewright.streaming import ingest


def png(width: int, height: int, colour=(10, 20, 30)) -> bytes:
    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + bytes(colour) * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


PDF = b"%PDF-1.4\n1 0 obj<</Type /Catalog /Pages 2 0 R>>endobj\n2 0 obj<</Type /Pages /Kids [3 0 R 4 0 R] /Count 2>>endobj\n3 0 obj<</Type /Page /Parent 2 0 R>>endobj\n4 0 obj<</Type/Page/Parent 2 0 R>>endobj\n%%EOF"


@pytest.fixture
def folder(tmp_path) -> Path:
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\rthree\xff")
    (tmp_path / "deep" / "B.MD").write_text("# md")
    (tmp_path / "deep" / "skip.xyz").write_text("no")
    (tmp_path / "deep" / "er" / "scan one.png").write_bytes(png(6, 4))
    (tmp_path / "bad.png").write_bytes(b"not an image")
    (tmp_path / "new.webp").write_bytes(b"RIFF")
    (tmp_path / "two.pdf").write_bytes(PDF)
    (tmp_path / "none.pdf").write_bytes(b"%PDF-1.4 nothing")
    return tmp_path


def render(content: bytes, page: int, scale: float) -> dict:
    import numpy as np

    if page == 2:
        raise RuntimeError("page broken")
    return packed(np.zeros((int(10 * scale), 5, 3), np.uint8))


def test_load(spark, folder):
    rows = {(r.filename, r.page_num): r for r in sources.load(spark, str(folder)).collect()}
    assert set(rows) == {("a.txt", 1), ("B.MD", 1), ("scan one.png", 1), ("bad.png", 1), ("new.webp", 1), ("two.pdf", 1), ("two.pdf", 2), ("none.pdf", 1)}
    assert rows["a.txt", 1].text == "one\ntwo\nthree�" and rows["a.txt", 1].data_type == "text"
    assert rows["B.MD", 1].extension == ".md" and rows["B.MD", 1].stem == "B"
    image = rows["scan one.png", 1].image
    assert (image.height, image.width, image.n_channels, bytes(image.data[:3])) == (4, 6, 3, bytes((30, 20, 10)))
    assert rows["scan one.png", 1].page_key == "scan one_page_01"
    assert rows["bad.png", 1].error and rows["new.webp", 1].error and rows["none.pdf", 1].error == "no pages found"
    assert rows["two.pdf", 2].total_pages == 2 and rows["two.pdf", 2].image is None
    good, failed = sources.readable(sources.load(spark, str(folder)))
    assert failed.count() == 3 and good.count() == 5


def test_missing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.load(spark, str(tmp_path / "nothing"))


def test_pdf_filter_and_renderer(spark, folder, monkeypatch):
    sys.modules["page_renderer_for_test"] = sys.modules[__name__]
    assert page_count(PDF) == 2
    rows = sources.load_pdfs(spark, str(folder), pages=[2]).collect()
    assert [(r.filename, r.page_num) for r in rows] == [("two.pdf", 2)]
    plan = spark.read.format("pdf_pages").option("path", str(folder)).load().where("page_num = 2")
    assert plan.count() == 1


def test_ground_truth(spark, tmp_path):
    for key, content in (("a b_page_01", {"ID": ["x", "y"]}), ("c_page_02", {"n": "z"})):
        (tmp_path / key).mkdir()
        (tmp_path / key / "identifiable_info.json").write_text(json.dumps(content))
    got = {(r.page_key, r.term) for r in load_ground_truth(spark, str(tmp_path)).collect()}
    assert got == {("a b_page_01", "x"), ("a b_page_01", "y"), ("c_page_02", "z")}


def test_named_files(spark, tmp_path):
    rows = spark.createDataFrame([("d_page_01", "ü one"), ("d_page_02", None), ("e_page_01", "x")], "page_key string, text string")
    sinks.write_named(sinks.page_files(rows), str(tmp_path / "out"))
    assert (tmp_path / "out/d/d_page_01.md").read_text(encoding="utf-8") == "ü one"
    assert (tmp_path / "out/d/d_page_02.md").read_text() == ""
    sinks.write_named(sinks.merged_files(rows), str(tmp_path / "merged"))
    assert sorted(p.name for p in (tmp_path / "merged").iterdir()) == ["d_complete.md", "e_complete.md"]
    numbered = spark.createDataFrame([("d", 3, "t")], "stem string, page_num int, text string")
    assert sinks.transcription_files(numbered).first().name == "d/Page_03.md"


def test_merged_files_are_written_page_by_page(spark, tmp_path):
    rows = spark.createDataFrame([(f"d_page_{k:02d}", f"text ü {k}" if k % 3 else None) for k in (10, 2, 100, 1)] + [("e f", "x"), (None, "y")], "page_key string, text string")
    sinks.write_merged(rows, str(tmp_path / "out"))
    want = {f"{r.stem}_complete.md": r.document for r in sinks.merged_documents(rows).collect()}
    assert {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "out").iterdir()} == want and len(want) == 2


def test_transcriptions_wipe_their_folder(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "old").write_text("x")
    sinks.write_transcriptions(spark.createDataFrame([("s", 7, "new")], "stem string, page_num int, text string"), str(tmp_path / "t"))
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["s"] and (tmp_path / "t/s/Page_07.md").read_text() == "new"


def test_unreadable_files_are_rows(spark, tmp_path):
    (tmp_path / "a.TXT").write_bytes(b"x\xff\r\ny")
    (tmp_path / "b.txt").write_text("fine")
    (tmp_path / "b.txt").chmod(0)
    (tmp_path / "c.webp").write_bytes(b"w")
    got = {r.filename: (r.text, r.error) for r in sources.load_texts(spark, str(tmp_path)).collect()}
    assert got["a.TXT"] == ("x\ufffd\ny", None) and set(got) == {"a.TXT", "b.txt"}
    images = sources.load_images(spark, str(tmp_path), decoder="json:loads").collect()
    assert [(r.filename, r.error) for r in images] == [("c.webp", "no decoder for this type")]


def test_reports(spark, tmp_path):
    meta = spark.createDataFrame([("p", "s", 1, True, False), ("failed", "s", 2, None, None)], "page_key string, stem string, page int, rotated boolean, composite boolean")
    audit = spark.createDataFrame([("p", ["a", "b"])], "page_key string, redacted_entities array<string>")
    report = sinks.debug_report(meta, audit)
    assert {tuple(r) for r in report.collect()} == {("s", 1, True, False, "a, b"), ("s", 2, None, None, "None")}
    sinks.write_csv(report, str(tmp_path / "csv"))
    header = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()[0]
    assert header == "Filename,Page,Rotated,Composite Image,De-id Info Removed"
    names = sinks.split_names(spark.createDataFrame([("a.b.jpg", 2), ("c.png", 1)], "original_file string, pages_output int"))
    assert {r.name for r in names.collect()} == {"a.b_page_1.jpg", "a.b_page_2.jpg", "c.jpg"}
    sinks.preprocess_log(spark.createDataFrame([("f", None, "FAILED")], "original_file string, pages_output int, status string"), str(tmp_path / "log"))
    assert json.loads("".join(p.read_text() for p in (tmp_path / "log").glob("*.json"))) == {"original_file": "f", "status": "FAILED"}
    step = spark.range(1).select(sinks.step_name(F.lit("s"), F.lit(7), "00_original")).first()[0]
    assert step == "s_page_07_00_original.jpg"


def test_pipeline(spark, folder):
    results, meta, failed = pipeline.run(spark, str(folder), "size", PipelineConfig())
    assert {r.page_key: r.text for r in results.collect()} == {"scan one_page_01": "6 x 4"}
    row = meta.first()
    assert (row.stem, row.page, row.rotated, row.composite, row.removed_info) == ("scan one", 1, False, False, [])
    assert failed.count() == 3
    texts, _, _ = pipeline.run(spark, str(folder), "size", PipelineConfig(pages=(2,)), skip_deid=True)
    assert texts.count() == 0
    with pytest.raises(LookupError):
        pipeline.run(spark, str(folder), "unknown")


def test_deidentified_with_replies(spark):
    pages = spark.createDataFrame([("p", "# Note\n\nSeen by Ann Smith, ann@x.test")], "page_key string, text string")
    replies = spark.createDataFrame([("p", 0, "Patient Names & DOBs", '{"contains_pii": false, "extracted_identifiers": ["Smith"]}'), ("p", 0, "Hospital Names", "broken")], "page_key string, chunk_idx int, task string, raw_content string")
    row = pipeline.deidentified(pages, backends.ReplyTable(replies)).first()
    assert row.clean_ocr == "Note Seen by Ann Smith, ann@x.test" and row.final_llm_scrubbed == "Note Seen by Ann ***, ***"
    assert row.redacted_entities == ["Smith", "ann@x.test"]


def test_oriented_crops(spark):
    import numpy as np

    a = np.zeros((4, 8, 3), np.uint8)
    a[0, 0] = 9
    schema = "page_key string, image struct<height:int,width:int,n_channels:int,mode:int,data:binary>"
    rows = spark.createDataFrame([("p", tuple(packed(a).values())), ("q", tuple(packed(a).values()))], schema)
    readings = spark.createDataFrame([("p", 0, 90, 9.0)], "page_key string, patch int, angle int, confidence double")
    replies = spark.createDataFrame([("q", '{"thinking": "", "is_composite_spread": true}'), ("p", '{"thinking": "", "is_composite_spread": true}')], "page_key string, raw_content string")
    got = {(r.page_key, r.crop_idx): (r.image.height, r.image.width, r.rotated, r.composite) for r in pipeline.oriented_crops(rows, readings, replies).collect()}
    assert got["p", 0] == (8, 4, True, False)  # upright after the turn, so it isn't asked about
    assert got["q", 0][3] and got["q", 1][3] and got["q", 0][1] + got["q", 1][1] == 8


def test_reply_cache(spark):
    asked = spark.createDataFrame([("p", 0, "t", "same"), ("q", 0, "t", "same"), ("r", 0, "t", "other")], "page_key string, chunk_idx int, task string, chunk string")
    known = asked.where("page_key = 'r'").select(F.sha2("chunk", 256).alias("chunk_hash"), "task", F.lit("m").alias("model"), F.lit("old").alias("raw_content"))
    seen = []

    class Source:
        def answer(self, questions):
            seen.append(questions.count())
            return questions.withColumn("raw_content", F.lit("new"))

    whole, new = backends.cached(asked, known, Source(), "m")
    assert {r.page_key: r.raw_content for r in whole.collect()} == {"p": "new", "q": "new", "r": "old"}
    assert seen == [1] and new.count() == 1


def test_failing_crop_is_empty(spark):
    class Broken:
        def run(self, images):
            raise RuntimeError

        def unload(self):
            pass

    backends.TRANSCRIBERS["broken"] = Broken
    try:
        schema = "page_key string, crop_idx int, image struct<height:int,width:int,n_channels:int,mode:int,data:binary>"
        rows = spark.createDataFrame([("p", 0, (1, 1, 1, 0, b"x"))], schema)
        assert backends.transcribed(rows, "broken").first().text == ""
    finally:
        del backends.TRANSCRIBERS["broken"]


def test_command_line(spark, folder, tmp_path, capsys):
    out = tmp_path / "cli"
    assert cli.main(["--in", str(folder), "--out", str(out), "--skip-deid", "--debug"]) == 0
    assert (out / "scan one" / "scan one_page_01.md").read_text() == "6 x 4"
    assert (out / "debug_report").is_dir()
    assert cli.main(["--in", str(folder), "--out", str(out), "--pages", "1,x"]) == 1
    assert cli.main(["--in", str(folder / "nothing"), "--out", str(out)]) == 1
    assert cli.main(["--in", str(folder), "--out", str(out), "--transcriber", "unknown"]) == 1


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "s_page_01.txt").write_text("mail a@b.test")
    for _ in range(2):
        ingest.stream_redacted(spark, str(source), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.page_key, r.final_llm_scrubbed) for r in rows] == [("s_page_01", "mail ***")]  # the second run adds nothing


def test_windows(spark):
    rows = spark.sql("select timestamp'2024-01-01 00:10:00' ts, 'a' event_type, 1.0D value union all select timestamp'2024-01-01 00:50:00', 'a', 3.0D union all select timestamp'2024-01-01 01:00:00', 'a', 5.0D")
    got = sorted((r.n, r.mean_value) for r in ingest.windowed(rows).collect())
    assert got == [(1, 5.0), (2, 2.0)]
