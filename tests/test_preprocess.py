"""Turning, splitting, layout and image files by hand-made images and backends."""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagewright import backends, engines
from pagewright.config import PipelineConfig
from pagewright.functions import replies, strings
from pagewright.operators import images, layout, preprocess, redaction
from pagewright.plans import pipeline
from pagewright.sinks import files as sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the backends below travel with their code

IMAGE = "image struct<height:int,width:int,n_channels:int,mode:int,data:binary>"
PAGES = f"page_key string, stem string, page_num int, {IMAGE}"


def image(h, w, mark=None):
    a = np.full((h, w, 3), 200, np.uint8)
    if mark:
        a[mark] = 9
    return a


def row(key, array):
    return key, key, 1, tuple(images.packed(array).values())


class CornerReader:
    """Sure of images with a dark first pixel; of patches only if they have the page's dark spot in them."""

    def read(self, image):
        a = images.pixels(image)
        if a[0, 0, 0] == 9:
            return "Rotate: 90\nOrientation confidence: 9.5"
        if (a == 7).any() and max(a.shape[:2]) <= 20:
            return "Rotate: 180\nOrientation confidence: 4.01"
        if (a == 5).all():
            raise RuntimeError
        return "Rotate: 270\nOrientation confidence: 4.0"


class Oracle:
    def ask(self, image, question):
        if question == "rotation":
            return '{"thinking": "x", "rotation_angle": "270"}' if images.pixels(image)[0, -1, 0] == 9 else "none"
        return 'So: {"thinking": "", "is_composite_spread": true}'


@pytest.fixture
def registered(monkeypatch):
    monkeypatch.setitem(backends.READERS, "corner", CornerReader)
    monkeypatch.setitem(backends.MODELS, "oracle", Oracle)


def test_pages_are_turned_and_split_in_one_narrow_pass(spark, registered):
    spot = image(40, 30)
    spot[20, 15] = 7
    rows = [row("corner", image(20, 30, (0, 0))), row("spot", spot), row("model", image(30, 20, (0, -1))), row("broad", image(20, 60)), row("fails", np.full((9, 6, 3), 5, np.uint8))]
    pages = spark.createDataFrame(rows, PAGES)
    made = preprocess.prepared(pages, "corner", "oracle", "oracle")
    got = {(r.page_key, r.crop_idx): r for r in made.collect()}
    assert (got["corner", 0].angle, got["corner", 0].tier, got["corner", 0].image.height, got["corner", 0].rotated) == (90, "page", 30, True)
    assert (got["spot", 0].angle, got["spot", 0].tier) == (180, "patch")
    assert (got["model", 0].angle, got["model", 0].tier) == (270, "model") and got["model", 1].composite  # broad after the turn
    assert got["broad", 0].composite and got["broad", 0].image.width + got["broad", 1].image.width == 60
    assert (got["fails", 0].angle, got["fails", 0].tier, got["fails", 0].rotated) == (0, "model", False)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    alone = {r.page_key: (r.tier, r.rotated, r.composite) for r in preprocess.prepared(pages).collect()}
    assert set(alone.values()) == {("none", False, False)} and len(alone) == 5
    with pytest.raises(LookupError):
        preprocess.prepared(pages, "nobody")


def test_the_whole_pipeline_turns_and_splits(spark, registered, tmp_path):
    (tmp_path / "wide.png").write_bytes(images.png(images.packed(image(20, 60))))
    (tmp_path / "flat.png").write_bytes(images.png(images.packed(image(20, 30, (0, 0)))))
    config = PipelineConfig(orientation_reader="corner", spread_model="oracle")
    results, meta, _ = pipeline.run(spark, str(tmp_path), "size", config, skip_deid=True)
    flags = {r.stem: (r.page, r.rotated, r.composite) for r in meta.collect()}
    texts = {r.page_key: r.text for r in results.collect()}
    assert flags == {"wide": (1, False, True), "flat": (1, True, False)}
    assert texts["flat_page_01"] == "20 x 30" and texts["wide_page_01"].count("x 20") == 2


def test_patches_repeat_and_fit():
    a = np.arange(30 * 20 * 3, dtype=np.uint8).reshape(30, 20, 3)
    one, two = list(preprocess.views(a, "k", 9)), list(preprocess.views(a, "k", 9))
    assert len(one) == 10 and all((x == y).all() for x, y in zip(one, two)) and {x.shape for x in one[1:]} == {(15, 10, 3)}
    assert len(list(preprocess.views(a[:1], "k", 9))) == 1


def test_replies_in_tasks_are_those_of_columns(spark):
    raw = ['{"thinking": "", "rotation_angle": %s}' % v for v in ("90", '"180"', "270.0", "90.5", "45", "null", '" 90 "', '"up"')] + ["none", None, '{"rotation_angle": 90}', 'x {"thinking": "a\n", "rotation_angle": 180} y']
    raw += ['{"thinking": "", "is_composite_spread": %s}' % v for v in ("true", '"yes"', "1", "0", "2", '"on"', "null", "false", '"no"')]
    rows = spark.createDataFrame([(r,) for r in raw], "raw string").select("raw", replies.rotation_angle(F.col("raw")).alias("angle"), replies.is_spread(F.col("raw")).alias("spread")).collect()
    for r in rows:
        assert (replies.angle_of_reply(r.raw), replies.spread_of_reply(r.raw)) == (r.angle, r.spread), r.raw
    assert strings.reading_of("Rotate: 90\nOrientation confidence: 7.5") == (90, 7.5) and strings.reading_of("") == (None, None)


def test_kernels_by_brute_force():
    rng = np.random.default_rng(1)
    a = rng.random((23, 31)) < 0.06
    wide, h, w = np.zeros_like(a), *a.shape
    for y in range(h):
        for x in range(w):
            wide[y, x] = a[max(0, y - 2) : y + 2, max(0, x - 2) : x + 3].any()  # 5 columns, 4 rows
    back = np.array([[wide[max(0, y - 1) : y + 3, max(0, x - 2) : x + 3].all() for x in range(w)] for y in range(h)])
    assert (images.closed(a, 5, 4) == back).all() and (images.closed(a, 5, 4) >= a).all()
    seen, parts = np.zeros_like(a), []
    for y, x in zip(*np.nonzero(a)):
        if not seen[y, x]:
            stack, cells = [(y, x)], []
            seen[y, x] = True
            while stack:
                p, q = stack.pop()
                cells.append((p, q))
                for s in range(max(0, p - 1), min(h, p + 2)):
                    for t in range(max(0, q - 1), min(w, q + 2)):
                        if a[s, t] and not seen[s, t]:
                            seen[s, t] = True
                            stack.append((s, t))
            ys, xs = zip(*cells)
            parts.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    assert [box for box, _ in images.components(a)] == sorted(map(tuple, np.array(parts).tolist()))
    grey = np.concatenate([rng.normal(60, 8, 500), rng.normal(190, 9, 900)]).clip(0, 255).reshape(20, 70)
    assert images.dark(grey).sum() == (grey < 120).sum()
    big = rng.integers(0, 255, (90, 50, 3)).astype(np.uint8)
    assert images.resized(big, 30).shape[0] == 30 and images.resized(big, 90) is big and abs(images.resized(big, 30).mean() - big.mean()) < 1


def page_with_blocks():
    a = np.full((400, 300, 3), 250, np.uint8)
    for y in range(50, 110, 14):  # lines of one paragraph
        a[y : y + 8, 40:260:3] = 10
    for y in range(220, 300, 14):
        a[y : y + 8, 60:200:2] = 20
    a[380:383, 5:9] = 0  # a speck
    return a


def test_blocks_become_padded_regions(spark):
    rows = spark.createDataFrame([("p", tuple(images.packed(page_with_blocks()).values()))], f"page_key string, {IMAGE}")
    got = layout.regions(rows).collect()
    assert [r.region_id for r in got] == ["region_01_layout_block", "region_02_layout_block"]
    assert got[0].bbox.asDict() == {"x0": 34, "y0": 44, "x1": 266, "y1": 120} and got[0].image.width == 232
    with pytest.raises(LookupError):
        layout.regions(rows, "nobody").collect()


class Marks:
    """Finds each dark pixel's surroundings."""

    def detect(self, array):
        assert array.shape[0] == array.shape[1]
        return [((int(x) - 5, int(y) - 5, int(x) + 6, int(y) + 6), "mark") for y, x in zip(*np.nonzero((array == 0).all(2)))]


def test_strips_find_each_thing_once(spark, monkeypatch):
    monkeypatch.setitem(backends.DETECTORS, "marks", Marks)
    a = image(1700, 90)
    for y, x in ((2, 2), (700, 40), (1699, 89)):  # at the edges, and where strips overlap
        a[y, x] = 0
    assert [at for at, _ in layout.strips_of(a)] == [0, 600, 1200]
    rows = spark.createDataFrame([("p", tuple(images.packed(a).values()))], f"page_key string, {IMAGE}")
    got = [tuple(r.bbox) for r in layout.regions(rows, "marks", 0, True).collect()]
    assert got == [(0, 0, 8, 8), (35, 695, 46, 706), (84, 1694, 90, 1700)]


def test_image_files(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 255, (7, 5, 3)).astype(np.uint8)
    crops = spark.createDataFrame([("s", 3, 0, True, tuple(images.packed(a).values())), ("s", 3, 1, True, tuple(images.packed(a[:, :2]).values()))], f"stem string, page_num int, crop_idx int, composite boolean, {IMAGE}")
    sinks.write_images(sinks.step_images(crops, "00_original"), str(tmp_path / "debug"))
    sinks.write_images(sinks.split_images(crops), str(tmp_path / "split"))
    assert sorted(p.name for p in (tmp_path / "debug").iterdir()) == ["s_page_03_00_original.png", "s_page_03_00_original_1.png"]
    assert sorted(p.name for p in (tmp_path / "split").iterdir()) == ["s_page_1.png", "s_page_2.png"]
    read = spark.read.format("image").load(str(tmp_path / "debug")).where("image.width = 5").first().image
    assert bytes(read.data) == a.tobytes()
    pages = spark.createDataFrame([("p", tuple(images.packed(page_with_blocks()).values()))], f"page_key string, {IMAGE}")
    regions = layout.regions(pages)
    drawn = images.pixels(sinks.overlays(pages, regions).first().image.asDict())
    assert (drawn[44, 34:266] == (0, 0, 255)).all() and (drawn[0] == 250).all()
    sinks.write_images(sinks.region_images(regions), str(tmp_path / "crops"))
    assert len(list((tmp_path / "crops" / "p").iterdir())) == 2
    grey = images.png(images.packed(a[..., :1]))
    assert zlib.decompress(grey[grey.index(b"IDAT") + 4 : -16])[1:6] == a[0, :, 0].tobytes()


def test_coercion(tmp_path):
    a = image(2, 3)
    assert (images.to_bgr(a) == a).all() and images.to_bgr(a) is not a
    (tmp_path / "x").write_bytes(b"abc")
    assert images.to_bgr(tmp_path / "x", lambda b: np.frombuffer(b, np.uint8)).tolist() == [97, 98, 99]

    class Converts:
        def convert(self, mode):
            return np.dstack([np.full((1, 1), k) for k in (1, 2, 3)])

    assert images.to_bgr(Converts()).tolist() == [[[3, 2, 1]]]
    for bad in (5, None, str(tmp_path / "x")):
        with pytest.raises(TypeError):
            images.to_bgr(bad)


def test_engines_get_whole_batches(spark, monkeypatch):
    class Counting:
        def run(self, found):
            return [f"{len(found)}"] * len(found)

        def unload(self):
            pass

    monkeypatch.setitem(backends.TRANSCRIBERS, "counting", Counting)
    one = tuple(images.packed(image(1, 1)).values())
    rows = spark.createDataFrame([("p", 0, one, "a"), ("p", 1, one, "b"), ("p", 2, (0, 0, 3, 16, b""), "c"), ("q", 0, None, "d")], f"page_key string, crop_idx int, {IMAGE}, flag string").coalesce(1)
    got = {(r.page_key, r.crop_idx): (r.flag, r.text) for r in backends.transcribed(rows, "counting", "flag").collect()}
    assert got == {("p", 0): ("a", "2"), ("p", 1): ("b", "2"), ("p", 2): ("c", ""), ("q", 0): ("d", "")}


def test_chunks_are_recognised_with_the_pages_offsets(spark, monkeypatch):
    class Names:
        def entities(self, chunks):
            return [[("NAME", k, k + 5) for k in range(len(c)) if c.startswith("Smith", k)] for c in chunks]

    monkeypatch.setitem(backends.RECOGNISERS, "names", Names)
    text = "word " * 310 + "Smith " * 3 + "word " * 310 + "Smith"
    pages = spark.createDataFrame([("p", text), ("q", ""), ("r", None)], "page_key string, text string")
    got = {r.page_key: r.entities for r in redaction.recognised(pages, "names").collect()}
    assert [text[e.start : e.end] for e in got["p"]] == ["Smith"] * 4 and got["q"] == got["r"] == []
    source = backends.ReplyTable(spark.createDataFrame([], "page_key string, chunk_idx int, task string, raw_content string"))
    done = pipeline.deidentified(pages.where("page_key = 'p'"), source, PipelineConfig(recogniser="names")).first()
    assert "Smith" not in done.final_llm_scrubbed and done.final_llm_scrubbed.count("***") == 4 and done.redacted_entities == ["Smith"]


def test_engines_around_what_they_wrap():
    grey, colour = images.packed(np.full((1, 2, 1), 7, np.uint8)), images.packed(np.array([[[1, 2, 3]]], np.uint8))
    assert engines.rgb(colour).tolist() == [[[3, 2, 1]]] and engines.rgb(grey).tolist() == [[7, 7]]

    class Tree:
        def __call__(self, arrays):
            self.shape = arrays[0].shape
            return self

        def export(self):
            if self.shape[1] == 1:
                raise RuntimeError
            return {"pages": [{"blocks": [{"lines": [{"words": [{"value": "a"}, {"value": "b"}]}, {"words": [{"value": "c"}]}]}]}]}

    assert engines.TreeEngine(Tree()).run([grey, colour]) == ["a b\nc", ""]

    class Client:
        def batch_two_step_extract(self, arrays):
            return [[{"content": " x "}, {"text": "y"}, {"content": None}] for _ in arrays]

    assert engines.BlockEngine(Client(), lambda a: a).run([grey, colour]) == ["x\n\ny"] * 2 and engines.BlockEngine(Client(), lambda a: a).run([]) == []

    class Model:
        def apply_chat_template(self, asked, **options):
            return asked[0]["content"][1]["text"]

        def __call__(self, text, images, return_tensors):
            return {"input_ids": [[ord(c) for c in text]]}

        def generate(self, input_ids, max_new_tokens, **options):
            return [input_ids[0] + [ord(c) for c in " read "][:max_new_tokens]]

        def batch_decode(self, rows, skip_special_tokens):
            return ["".join(map(chr, row)) for row in rows]

    model = Model()
    assert engines.PromptEngine("table", 5, model, model, lambda a: a).run([colour]) == ["read"]
    with pytest.raises(ValueError):
        engines.PromptEngine("poem", processor=model, generator=model)


def test_contrast():
    rng = np.random.default_rng(2)
    faint = np.repeat(rng.integers(150, 191, (160, 120)).astype(np.uint8)[..., None], 3, 2)
    made = images.contrasted(faint)
    assert made.shape == faint.shape and made.std() > 1.8 * faint.std()
    assert np.corrcoef(made.ravel(), faint.ravel())[0, 1] > 0.97  # brighter pixels stay brighter
    assert (images.contrasted(np.zeros((3, 2, 3), np.uint8)) == 0).all()
    tinted = np.dstack([faint[..., 0] // 2, faint[..., 1], faint[..., 2]])
    parts = images.contrasted(tinted).astype(float)
    assert abs(parts[..., 0] / np.maximum(parts[..., 1], 1) - 0.5).max() < 0.1
