"""Reading on in page order until enough rows are found."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from listinglake.operators.dedupe import dedupe_first
from listinglake.operators.topk import cap, check_cap
from listinglake.operators.union import union_all
from listinglake.session import settled


def cap_in_page_order(
    rows_of: Callable[[int], DataFrame],
    stretches: list[int],
    n: int,
    keys: list[str],
    accept: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    whole_first_page: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """The first ``n`` accepted rows, without reading pages behind the last one needed.

    ``rows_of`` gives the rows of a stretch of pages; stretches ascend in page order.  A
    row whose keys an earlier page had is dropped before ``accept`` sees it, inside a
    stretch as well; ``whole_first_page`` keeps repeats inside the first stretch.  The
    result equals the cap over all pages.

    A stretch is parsed once and written; what it adds decides whether the next one is
    looked at, so at most twice the pages needed are read, and in as many steps as the
    page number has binary digits.
    """
    check_cap(n)
    taken: list[DataFrame] = []
    seen: list[DataFrame] = []
    have = 0
    for i, stretch in enumerate(stretches):
        if have >= n:
            break
        rows = rows_of(stretch)
        if not (whole_first_page and i == 0 and stretch == 0):
            rows = dedupe_first(rows, keys, order)
        if seen:
            # Written before, so Spark knows its size and can split a hot key of the rows.
            rows = rows.join(union_all(seen), keys, "left_anti")
        rows = settled(rows, "stretch")
        seen.append(rows.select(*keys))
        taken.append(accept(rows))
        have += taken[-1].limit(n - have).count()
    if not taken:
        return rows_of(0).limit(0)
    return cap(union_all(taken), n, order)
