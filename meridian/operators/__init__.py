"""Composite DataFrame operators (each is a plain function over DataFrames)."""

from meridian.operators.reshape import explode_list  # noqa: F401
from meridian.operators.allocate import allocate_evenly  # noqa: F401
from meridian.operators.ranking import top_k_per_group  # noqa: F401
from meridian.operators.spatial import count_within_radius, nearest_k, within_radius  # noqa: F401
from meridian.operators.merge import anti_join, dedupe_by_key  # noqa: F401
