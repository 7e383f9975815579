"""Column-level helpers shared by the operators."""

from .hashing import hash_prefix_int, order_hash, pick_index
from .lexicon import PROBE_LEXICON, lexicon_frame, lexicon_rows
from .ranking import bucket_offsets, label_by_cut_points, running_count
from .text import after_first, first_line, strip_ws, word_tokens

__all__ = [
    "hash_prefix_int", "order_hash", "pick_index",
    "PROBE_LEXICON", "lexicon_frame", "lexicon_rows",
    "bucket_offsets", "label_by_cut_points", "running_count",
    "after_first", "first_line", "strip_ws", "word_tokens",
]
