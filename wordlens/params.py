"""Parameters of the term-count job, as keyword arguments instead of a config file."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the job being re-implemented for equal results.
# Stop words shipped with the job's default configuration file (17 entries):
SHIPPED_STOP_WORDS = (
    "the", "is", "are", "and", "this", "that", "a", "&", "for", "to", "in", "with",
    "your", "of", "an", "or", "on",
)
# Seeds the job starts its state from (count seed, URL-filter seed, sketch seed):
SEED_WORD = "amazon"
SEED_URL = "http://www.amazon.com/"
# The dummy value of a URL record:
RECORD_VALUE = 0
# Algorithm defaults: Bloom filter capacity / false-positive rate, count-min sketch
# top-k, delta, eps, seed and heavy-hitter share; micro-batch interval in seconds.
BLOOM_EXPECTED_ITEMS = 1000
BLOOM_FPP = 0.03
CMS_TOPK = 10
CMS_DELTA = 1e-3
CMS_EPS = 0.01
CMS_SEED = 1
CMS_HEAVY_HITTER_PCT = 0.001
BATCH_SECONDS = 60
# ---------------------------------------------------------------------------
# Topic that URL records go to unless another is named.
DEFAULT_TOPIC = "urls"


def cms_shape(eps: float, delta: float) -> tuple[int, int]:
    """(depth, width) of a count-min sketch: d = ceil(ln 1/delta), w = ceil(e / eps)."""
    if not 0.0 < eps < 1.0 or not 0.0 < delta < 1.0:
        raise ValueError("eps and delta must be in (0, 1)")
    return int(math.ceil(math.log(1.0 / delta))), int(math.ceil(math.e / eps))


@dataclass(frozen=True)
class TermConfig:
    """All knobs of the streaming term-count job in one place.

    ``mode`` is "count", "topk" or "both". ``cms_eps`` defaults to half the heavy-hitter share: with
    CMS_EPS the error bound (1% of all words) is ten times the threshold (0.1%) and every word
    passes it. ``topics`` and ``batch_seconds`` are the stream's topic list and trigger interval.
    Seeds: ``seed_counts`` start the totals, the words among them also the sketch; ``seed_urls`` count as processed.
    """

    stop_words: tuple[str, ...] = SHIPPED_STOP_WORDS
    drop_empty: bool = True
    topics: str = DEFAULT_TOPIC
    batch_seconds: int = BATCH_SECONDS
    mode: str = "both"
    bloom_expected_items: int = BLOOM_EXPECTED_ITEMS
    bloom_fpp: float = BLOOM_FPP
    topk: int = CMS_TOPK
    cms_delta: float = CMS_DELTA
    cms_eps: float = CMS_HEAVY_HITTER_PCT / 2
    cms_seed: int = CMS_SEED
    heavy_hitter_pct: float = CMS_HEAVY_HITTER_PCT
    seed_counts: tuple[tuple[str, int], ...] = field(default_factory=tuple)
    seed_urls: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        if self.mode not in ("count", "topk", "both"):
            raise ValueError(f"mode must be count, topk or both, not {self.mode!r}")

    @property
    def counts_enabled(self) -> bool:
        return self.mode in ("count", "both")

    @property
    def sketch_enabled(self) -> bool:
        return self.mode in ("topk", "both")
