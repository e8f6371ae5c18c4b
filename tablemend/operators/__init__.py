from tablemend.operators.assets import (
    list_files,
    manifest,
    publish,
    publish_counts,
    with_listed_presence,
    with_presence,
)
from tablemend.operators.dedup import (
    DedupRule,
    deduplicate,
    deduplicate_all,
    deduplicate_by_digest,
    distinct_texts,
    distinct_values,
)
from tablemend.operators.enrich import join_all, left_join
from tablemend.operators.hierarchy import HierarchyError, ancestors, reduce_to_deepest, reduce_to_deepest_of_all
from tablemend.operators.integrity import (
    Checked,
    Target,
    all_broken_keys,
    broken_keys,
    enforce,
    orphan_counts,
    orphans,
    rows_with_keys,
    sweep,
)
from tablemend.operators.keys import contains_key, mark_key, with_key_in, with_key_not_in
from tablemend.operators.normalize import normalize, normalize_all, normalize_lenient, rejects
from tablemend.operators.project import (
    declared_columns,
    project_all,
    project_to_target,
    target_columns,
    without_columns,
)
from tablemend.operators.quality import fill_defaults, profile, repeated_keys, violations

__all__ = [
    "Checked",
    "DedupRule",
    "HierarchyError",
    "Target",
    "all_broken_keys",
    "ancestors",
    "broken_keys",
    "contains_key",
    "declared_columns",
    "deduplicate",
    "deduplicate_all",
    "deduplicate_by_digest",
    "distinct_texts",
    "distinct_values",
    "enforce",
    "fill_defaults",
    "join_all",
    "left_join",
    "list_files",
    "manifest",
    "mark_key",
    "normalize",
    "normalize_all",
    "normalize_lenient",
    "orphan_counts",
    "orphans",
    "profile",
    "project_all",
    "project_to_target",
    "publish",
    "publish_counts",
    "reduce_to_deepest",
    "reduce_to_deepest_of_all",
    "rejects",
    "repeated_keys",
    "rows_with_keys",
    "sweep",
    "target_columns",
    "violations",
    "with_key_in",
    "with_key_not_in",
    "with_listed_presence",
    "with_presence",
    "without_columns",
]
