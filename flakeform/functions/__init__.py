"""Column expressions. Everything here stays inside whole-stage code generation."""

from flakeform.functions.casts import lenient_cast
from flakeform.functions.keys import natural_hash, padded_sequence
from flakeform.functions.lengths import CONVENTIONAL_LENGTHS, DEFAULT_LENGTH, length_bucket
from flakeform.functions.text import initials, reduced_code, text_length

__all__ = [
    "CONVENTIONAL_LENGTHS",
    "DEFAULT_LENGTH",
    "initials",
    "length_bucket",
    "lenient_cast",
    "natural_hash",
    "padded_sequence",
    "reduced_code",
    "text_length",
]
