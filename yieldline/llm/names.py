"""Names that operators use inside, kept apart from the columns of their input."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame

OWN = "__"


def apart_from_input(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator use names that begin with two underscores: input columns of such names have others meanwhile.

    Its keyword or positional arguments that name such a column follow.
    """

    @functools.wraps(operator)
    def renamed(docs: DataFrame, *args, **options) -> DataFrame:
        taken = {c.lower() for c in docs.columns}
        free = (f"column{i}" for i in itertools.count() if f"column{i}" not in taken)
        names = {c: next(free) for c in docs.columns if c.startswith(OWN)}
        if not names:
            return operator(docs, *args, **options)

        def known(value):
            return names.get(value, value) if isinstance(value, str) else value

        done = operator(docs.withColumnsRenamed(names), *map(known, args), **{k: known(v) for k, v in options.items()})
        return done.withColumnsRenamed({other: c for c, other in names.items()})

    return renamed
