"""Every tunable of the engine in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

from . import fixed


@dataclass(frozen=True)
class Options:
    # Near-duplicate test.
    min_similarity: float = 0.82
    price_tolerance: float = 0.06
    surface_gap: float = 5.0

    # Comparable sales.
    as_of: str = "2024-12-31"
    surface_tolerance: float = 0.30
    max_age_months: int = 18
    min_band_rows: int = 5
    min_recent_rows: int = 5
    trend_years: tuple[int, int] = (2023, 2024)

    # Valuation and labels.
    min_evidence: int = 3
    undervalued_below: float = -8.0
    strongly_undervalued_below: float = -15.0
    overvalued_above: float = 10.0
    strongly_overvalued_above: float = 20.0
    default_zip: int = 75011
    default_type: str = "Appartement"
    scoring_date: str = "2024-06-01"

    # Answers of a hosted model.
    prompt_chars: int | None = None
    """Characters of a description that an address prompt holds; None for the whole text."""
    answering_model: str = fixed.ANSWERING_MODEL
    """Name in the memo's tag where the answers have no column ``model``."""

    # Quantile forest.
    smallest_forest: int = 200
    """Training sales up to which the statistical model takes the forest's place; 0 for never."""
    n_trees: int = 10
    tree_depth: int = 8
    tree_bins: int = 64
    leaf_rows: int = 20
    price_cuts: int = 512
    """Prices by which the sales of a leaf are counted."""

    # Sketched quantiles.
    sketch_k: int = 800
    """Size of a market's quantile sketch; ranks are off by about 0.35 % of its prices."""

    # Physical knobs; none of them changes a result.
    rows_per_slice: int = 20_000
    """Rows of one key that a look-up join keeps together; a key with more is cut into slices."""
    bucket_width: float = 16.0
    """Width, in euros per square metre, of the histogram behind exact quantiles. Keep it
    below the usual spread of prices: wider buckets cost digits of the deviation."""
    chunk_cells: int = 65_536
    """Sales cells of a market, in the order of price, that one task holds to answer for bands."""
    asks_per_copy: int = 100_000
    """Bands that one copy of such a chunk answers."""
    hot_cell_rows: int = 4096
    """Blocks of the near-duplicate join larger than this square are crowds; they may also block on address trigrams."""
    dense_cell_rows: int = 128
    """Blocks of a table with itself larger than this square are compared by whole lists of addresses."""
    trigram_row_cost: int = 1000
    """Comparisons that a row of such a block must be spared on average before it is keyed by its trigrams."""
    first_round_rows: int = 4096
    """Rows of the first of the growing rounds in which zips with large blocks are resolved."""
    replay_pairs: int = 1_000_000
    """Matches that one task replays in order, as whole zips or whole components of them."""
    broadcast_rows: int = 200_000
    """Row count up to which the counted table of crowded blocks may be broadcast."""


DEFAULTS = Options()
