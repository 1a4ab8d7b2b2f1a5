"""Adapters of public recognition engines to `backends.Transcriber`.

Their packages aren't part of this one: each adapter loads its engine when it is made, in the task that uses it, and is
registered only where the packages can be found.  What is done around an engine (colours, batches, joining what it says) is
here and doesn't need it.
"""

from __future__ import annotations

import importlib
import importlib.util
from typing import Any

import numpy as np

from . import backends
from .config import PipelineConfig
from .operators.images import pixels

#: Prompts of the prompted engine by task.
PROMPTS = {"ocr": "OCR:", "table": "Table Recognition:", "chart": "Chart Recognition:", "formula": "Formula Recognition:"}


def rgb(image: dict) -> np.ndarray:
    """An image struct as rows of RGB; grey images keep their one channel."""
    a = pixels(image)
    return a[..., 0] if a.shape[2] == 1 else np.ascontiguousarray(a[..., 2::-1])


def text_of_tree(tree: dict) -> str:
    """Words joined by blanks and lines by line ends, as `operators.documents.tree_text` does with columns."""
    lines = (line for page in tree["pages"] for block in page["blocks"] for line in block["lines"])
    return "\n".join(" ".join(word["value"] for word in line["words"]) for line in lines).strip()


def text_of_blocks(blocks: list) -> str:
    """The blocks' contents, stripped and joined by blank lines; those without one have no part in it."""
    told = (b.get("content") or b.get("text") if isinstance(b, dict) else getattr(b, "content", None) for b in blocks)
    return "\n\n".join(str(t).strip() for t in told if t)


class TreeEngine:
    """An engine that reads one page after another into a tree of blocks, lines and words."""

    packages = ("doctr",)

    def __init__(self, engine: Any = None):
        self.engine = engine or importlib.import_module("doctr.models").ocr_predictor(pretrained=True)

    def run(self, images: list[dict]) -> list[str]:
        out = []
        for image in images:
            try:
                a = rgb(image)
                out.append(text_of_tree(self.engine([a if a.ndim == 3 else np.repeat(a[..., None], 3, 2)]).export()))
            except Exception:  # one image's failure must not lose the others
                out.append("")
        return out

    def unload(self) -> None:
        self.engine = None


class BlockEngine:
    """An engine that takes all images of a batch at once and gives content blocks in reading order."""

    packages = ("mineru_vl_utils", "transformers", "PIL")
    model = "opendatalab/MinerU2.5-2509-1.2B"

    def __init__(self, client: Any = None, to_image: Any = None):
        if client is None:
            transformers = importlib.import_module("transformers")
            model = transformers.Qwen2VLForConditionalGeneration.from_pretrained(self.model, dtype="auto", device_map="auto").eval()
            processor = transformers.AutoProcessor.from_pretrained(self.model, use_fast=True)
            client = importlib.import_module("mineru_vl_utils").MinerUClient(backend="transformers", model=model, processor=processor)
        self.client = client
        self.to_image = to_image or importlib.import_module("PIL.Image").fromarray

    def run(self, images: list[dict]) -> list[str]:
        return [text_of_blocks(found) for found in self.client.batch_two_step_extract([self.to_image(rgb(i)) for i in images])] if images else []

    def unload(self) -> None:
        self.client = None


class PromptEngine:
    """A generating engine that is asked about one image after another; greedy, within a budget of tokens."""

    packages = ("transformers", "torch", "PIL")
    model = "PaddlePaddle/PaddleOCR-VL"

    def __init__(self, task: str = "ocr", budget: int = PipelineConfig.recognition_tokens, processor: Any = None, generator: Any = None, to_image: Any = None):
        if task not in PROMPTS:
            raise ValueError(f"no task {task!r}; there are {', '.join(PROMPTS)}")
        if generator is None:
            transformers = importlib.import_module("transformers")
            generator = transformers.AutoModelForCausalLM.from_pretrained(self.model, trust_remote_code=True).eval()
            processor = transformers.AutoProcessor.from_pretrained(self.model, trust_remote_code=True)
        self.task, self.budget, self.processor, self.generator = task, budget, processor, generator
        self.to_image = to_image or importlib.import_module("PIL.Image").fromarray

    def run(self, images: list[dict]) -> list[str]:
        asked = [{"role": "user", "content": [{"type": "image"}, {"type": "text", "text": PROMPTS[self.task]}]}]
        text = self.processor.apply_chat_template(asked, tokenize=False, add_generation_prompt=True)
        out = []
        for image in images:
            inputs = self.processor(text=text, images=self.to_image(rgb(image)), return_tensors="pt")
            made = self.generator.generate(**inputs, max_new_tokens=self.budget, do_sample=False, use_cache=True)
            new = [tokens[len(inputs["input_ids"][0]) :] for tokens in made]  # without the prompt's
            out.append(self.processor.batch_decode(new, skip_special_tokens=True)[0].strip())
        return out

    def unload(self) -> None:
        self.processor = self.generator = None


for _name, _engine in (("doctr", TreeEngine), ("mineru", BlockEngine), ("paddle-vl", PromptEngine)):
    if all(importlib.util.find_spec(p) for p in _engine.packages):
        backends.TRANSCRIBERS.setdefault(_name, _engine)
