from podium.operators.aggregate import (
    argmax_per_group,
    first_value,
    group_avg,
    group_count,
    group_first,
    group_max,
    overall_avg,
    pct_change,
)
from podium.operators.columns import (
    add_literal,
    align_and_union,
    conform,
    conform_or_reject,
    free_name,
    normalize_columns,
    project,
    quoted,
    rename,
    widens,
)
from podium.operators.layout import (
    filled_partition_count,
    partition_count,
    partition_sizes,
    persisted,
    release,
    release_all,
    repartition_by_rows,
    target_partitions,
)
from podium.operators.rank import first_place_counts, rank_in_partition, rank_of_argmax
from podium.operators.topk import (
    best_mean,
    filtered_top1,
    sort_desc,
    top1,
    top_k,
    top_rows,
    winner_rows,
)

__all__ = [
    "add_literal",
    "align_and_union",
    "argmax_per_group",
    "best_mean",
    "conform",
    "conform_or_reject",
    "filtered_top1",
    "filled_partition_count",
    "first_place_counts",
    "first_value",
    "free_name",
    "group_avg",
    "group_count",
    "group_first",
    "group_max",
    "normalize_columns",
    "overall_avg",
    "partition_count",
    "partition_sizes",
    "pct_change",
    "persisted",
    "project",
    "quoted",
    "rank_in_partition",
    "rank_of_argmax",
    "release",
    "release_all",
    "rename",
    "repartition_by_rows",
    "sort_desc",
    "target_partitions",
    "top1",
    "top_k",
    "top_rows",
    "widens",
    "winner_rows",
]
