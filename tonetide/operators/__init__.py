"""DataFrame in, DataFrame out."""

from tonetide.operators.joins import document_themes, join_mentions, possible_mentions, theme_tones
from tonetide.operators.serving import (
    latest_stored,
    latest_tone,
    tone_distribution,
    tone_evolution,
)
from tonetide.operators.sketches import merge_states, sketch_quantiles, state_stats, tone_states
from tonetide.operators.stats import collect_tones, tone_stats, tone_stats_multi
from tonetide.operators.vocabulary import (
    clean_codes,
    distinct_themes,
    filter_to_vocab,
    key_counts,
    top_k,
)

__all__ = [
    "clean_codes",
    "collect_tones",
    "distinct_themes",
    "document_themes",
    "filter_to_vocab",
    "join_mentions",
    "key_counts",
    "latest_stored",
    "latest_tone",
    "merge_states",
    "possible_mentions",
    "sketch_quantiles",
    "state_stats",
    "theme_tones",
    "tone_distribution",
    "tone_evolution",
    "tone_states",
    "tone_stats",
    "tone_stats_multi",
    "top_k",
]
