"""DataFrame-level operators: segment explode, skew-safe ordered scans,
polylines from vertex rows, shape-blob decoding, table helpers."""

from geoframe.operators.ordered import assign_object_ids, lag_in_group, running_sum
from geoframe.operators.segments import segments
from geoframe.operators.shapes import decode_shapes, shape_params
from geoframe.operators.tables import (data_extent, describe_fields, rows_as_json, rows_as_map,
                                       tolerance_check)
from geoframe.operators.trajectories import polylines_from_rows

__all__ = ["assign_object_ids", "lag_in_group", "running_sum", "segments", "decode_shapes",
           "shape_params", "data_extent", "describe_fields", "rows_as_json", "rows_as_map",
           "tolerance_check", "polylines_from_rows"]
