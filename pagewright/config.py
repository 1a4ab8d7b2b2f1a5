"""Parameters of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Words that the second redaction stage never removes.
SAFE_WORDS = (
    "and", "for", "the", "hospital", "hospitals", "on", "clinic",
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
)
#: File families by extension.
PDF_TYPES = (".pdf",)
IMAGE_TYPES = (".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp", ".webp")
TEXT_TYPES = (".txt", ".md", ".json", ".csv")
#: Layout labels that hold no content.
EMPTY_LABELS = ("PageHeader", "PageFooter", "BlankPage")
#: Angles that a page may be turned by.
ANGLES = (0, 90, 180, 270)
MASK = "***"
#: Names of the tasks of the second redaction stage.  The questions are in our wording.
TASKS = (
    ("UK Postcodes & Addresses", "List every postal address and postcode in the passage."),
    ("Hospital Names", "List every name of a hospital, clinic or practice in the passage."),
    ("Patient Names & DOBs", "List every person's name and date of birth in the passage; dates of visits stay."),
)


@dataclass(frozen=True)
class PipelineConfig:
    """What a run may change.  Defaults are those of the described behaviour."""

    stage1_chunk: int = 1500
    stage2_chunk: int = 1500
    stage2_overlap: int = 150
    min_confidence: float = 4.0
    max_patches: int = 100
    rotation_side: int = 896
    split_side: int = 1024
    band: tuple[float, float] = (0.40, 0.60)
    swallowed: float = 0.85
    fuzzy: float = 0.85
    close_matches: int = 5
    safe_words: tuple[str, ...] = SAFE_WORDS
    render_dpi: int = 200
    compat_tail: bool = False
    lexicographic_merge: bool = False
    centre_gutter: bool = False
    pages: tuple[int, ...] = field(default=())
    #: Names of registered backends; without one its stage decides nothing, and rules stand in for the recogniser.
    orientation_reader: str = ""
    rotation_model: str = ""
    spread_model: str = ""
    recogniser: str = ""
    #: Budgets handed to model backends, in tokens: layout, recognition, redaction's replies and context.
    layout_tokens: int = 8192
    recognition_tokens: int = 2048
    reply_tokens: int = 1536
    context_tokens: int = 5120
