from .codec import decode_event, encode_event, topic_of
from .labels import is_error, status_class
from .numeric import clamp, exact_sum, mean, round_half_up, round_ties_up
from .split import crc32_split, split_bounds

__all__ = [
    "clamp",
    "crc32_split",
    "decode_event",
    "encode_event",
    "exact_sum",
    "is_error",
    "mean",
    "round_half_up",
    "round_ties_up",
    "split_bounds",
    "status_class",
    "topic_of",
]
