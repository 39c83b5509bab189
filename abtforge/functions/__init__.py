"""Column expressions.  Everything here returns a ``Column`` (or works on names at plan
time) so that the work stays inside Catalyst and whole-stage codegen."""

from abtforge.functions.keys import client_key, date_key, obligation_key
from abtforge.functions.numeric import clip, finite_or_null, to_double
from abtforge.functions.rowwise import row_max, row_sum
from abtforge.functions.split import hash_bucket, hash_split, temporal_split

__all__ = [
    "client_key",
    "date_key",
    "obligation_key",
    "clip",
    "finite_or_null",
    "to_double",
    "row_max",
    "row_sum",
    "hash_bucket",
    "hash_split",
    "temporal_split",
]
