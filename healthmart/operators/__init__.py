from .joins import (IntegrityError, assert_unique, freq, lookup, not_in, semi,
                    valid_in)
from .keys import fixed_domain, freeze, release_scratch, with_dense_id
from .dml import (remap_key, restate, scd2_apply, scd2_close, scd2_open, update_from, update_where)
from .scd import scd2_merge

__all__ = ["IntegrityError", "assert_unique", "freq", "lookup", "not_in", "semi",
           "valid_in", "fixed_domain", "freeze", "release_scratch", "with_dense_id", "remap_key", "restate", "scd2_apply", "scd2_merge", "scd2_close", "scd2_open",
           "update_from", "update_where"]
