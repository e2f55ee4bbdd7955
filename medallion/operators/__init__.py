"""Relational building blocks (all DataFrame in, DataFrame out)."""

from medallion.operators.aggregates import (  # noqa: F401
    daily_aggregate,
    hourly_aggregate,
    locality_rollup,
    with_locality_key,
)
from medallion.operators.dedup import distinct_rows, latest_wins  # noqa: F401
from medallion.operators.joins import anti_join, semi_join  # noqa: F401
from medallion.operators.merge import (  # noqa: F401
    append_frame,
    empty_like,
    recompute_touched,
    upsert_frame,
)
from medallion.operators.quality import (  # noqa: F401
    KeySpec,
    duplicate_report,
    not_null,
    relationships,
    run_checks,
    unique,
)
from medallion.operators.selection import (  # noqa: F401
    fresh_chain,
    period_between,
    read_mark,
    select_children,
    write_mark,
)
from medallion.operators.watermark import fresh_ids, high_watermark, newer_than  # noqa: F401
