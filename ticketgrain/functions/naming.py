"""Facts encoded in experiment names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V


def _first_hit(name: Column, rules: Sequence[tuple[str, object]]) -> Column:
    return F.coalesce(*[F.when(F.contains(name, F.lit(key)), F.lit(value)) for key, value in rules])


def rank_of(name: Column) -> Column:
    return F.coalesce(_first_hit(name, V.NAME_RANKS), F.lit(V.NAME_RANK_DEFAULT)).cast("long")


def kind_of(name: Column) -> Column:
    baseline = F.when(F.endswith(name, F.lit(V.NAME_BASELINE_SUFFIX)), F.lit("lora_rank"))
    return F.coalesce(_first_hit(name, V.NAME_KINDS), baseline, F.lit(V.NAME_KIND_DEFAULT))


def parameter_of(name: Column) -> Column:
    baseline = F.when(F.endswith(name, F.lit(V.NAME_BASELINE_SUFFIX)), F.lit(V.NAME_PARAM_BASELINE))
    return F.coalesce(_first_hit(name, V.NAME_PARAMS), baseline, F.lit(V.NAME_PARAM_DEFAULT))
