from starloom.operators.columns import drop_columns, drop_sparse_columns, rename, sparse_columns
from starloom.operators.dedup import dedup, distinct_values
from starloom.operators.joins import bucketed_lookup_join, lookup_join
from starloom.operators.keys import with_surrogate_key
from starloom.operators.profile import (
    column_overview,
    describe,
    missing_profile,
    missing_profile_of_files,
    only_missing,
    shape,
)
from starloom.operators.quality import (
    check_foreign_key,
    check_not_null,
    check_row_counts,
    check_schema,
    check_source_target,
    check_unique,
    fail_if_any,
)
from starloom.operators.registry import new_members, unseen
from starloom.operators.rows import (
    drop_empty_rows,
    drop_incomplete_rows,
    peek,
    sparse_rows,
    with_missing_count,
)

__all__ = [
    "bucketed_lookup_join",
    "check_foreign_key",
    "check_not_null",
    "check_row_counts",
    "check_schema",
    "check_source_target",
    "check_unique",
    "column_overview",
    "dedup",
    "describe",
    "distinct_values",
    "drop_columns",
    "drop_empty_rows",
    "drop_incomplete_rows",
    "drop_sparse_columns",
    "fail_if_any",
    "lookup_join",
    "missing_profile",
    "missing_profile_of_files",
    "new_members",
    "only_missing",
    "peek",
    "rename",
    "shape",
    "sparse_columns",
    "sparse_rows",
    "unseen",
    "with_missing_count",
    "with_surrogate_key",
]
