from stepstream.functions.projections import (
    squared_pairs,
    to_map_rows,
    typed_projection,
    with_arrival_time,
    words,
)
from stepstream.functions.time import (
    epoch_micros,
    epoch_millis,
    epoch_seconds,
    instant,
    wall_clock,
)

__all__ = [
    "epoch_micros",
    "epoch_millis",
    "epoch_seconds",
    "instant",
    "squared_pairs",
    "to_map_rows",
    "typed_projection",
    "wall_clock",
    "with_arrival_time",
    "words",
]
